"""Recoding columns.

Every recode is a ``CASE WHEN`` chain of built-in predicates; mappings and
patterns are parameters, never row functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, ColumnOrName


def full_match(c: ColumnOrName, pattern: str) -> Column:
    """JVM ``String.matches``: the pattern must cover the whole value."""
    return _c(c).rlike(rf"\A(?:{pattern})\z")


def recode_full_match(c: ColumnOrName, pattern: str, if_match, otherwise) -> Column:
    """F5 (doors): a value that matches ``pattern`` wholly -> ``if_match``, else ``otherwise``."""
    col = _c(c)
    return F.when(col.isNull(), F.lit(None)).when(full_match(col, pattern), F.lit(if_match)) \
        .otherwise(F.lit(otherwise))


def recode_contains(c: ColumnOrName, needle: str, if_match: float = 0.0,
                    otherwise: float = 1.0) -> Column:
    """binary recode by substring (``two`` -> 0.0 else 1.0)."""
    col = _c(c)
    return F.when(col.isNull(), F.lit(None).cast("double")) \
        .when(F.contains(col, F.lit(needle)), F.lit(float(if_match))) \
        .otherwise(F.lit(float(otherwise)))


def recode_map(c: ColumnOrName, mapping: Mapping[str, float], fallback_cast: str = "double") -> Column:
    """code -> number, falling through to a cast of the value itself.

    Text that is neither a code nor a number becomes null (to be counted as a
    reject by the caller), not a task failure.
    """
    col = _c(c)
    expr = None
    for code, value in mapping.items():
        cond = col == F.lit(code)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    fallback = col.try_cast(fallback_cast)
    return fallback if expr is None else expr.otherwise(fallback)


def indicators(c: ColumnOrName, categories: Sequence[str], prefix: str = "",
               match: str = "contains") -> list[Column]:
    """F8: one 0/1 double column per category (one-hot by substring or equality)."""
    col = _c(c)
    out = []
    for cat in categories:
        hit = F.contains(col, F.lit(cat)) if match == "contains" else (col == F.lit(cat))
        out.append(hit.cast("double").alias(f"{prefix}{cat}"))
    return out


def impute_sentinel(c: ColumnOrName, sentinel: str = "?", value: float = 80.0,
                    cast: str = "double") -> Column:
    """a field that contains the sentinel gets a constant, others are cast."""
    col = _c(c)
    return F.when(F.contains(col.cast("string"), F.lit(sentinel)), F.lit(value)) \
        .otherwise(col.try_cast(cast))


def label_threshold(value: Column, threshold: Column | float, valid: Column | None = None,
                    above: str = "high", below: str = "low", error: str = "Error") -> Column:
    """``high`` above the threshold, ``low`` otherwise, ``Error`` when not a number."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    ok = value.isNotNull() if valid is None else (valid & value.isNotNull())
    return F.when(~ok | value.isNull(), F.lit(error)) \
        .when(value > thr, F.lit(above)).otherwise(F.lit(below))
