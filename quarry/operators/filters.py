"""Row filters.

Each filter is a declarative predicate, so Catalyst can push the parts it
understands (comparisons, ``StartsWith``, ``Contains``) into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _c, ColumnOrName


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    """Named columns only (the scan then reads only these)."""
    return df.select(*names)


def where_equals(df: DataFrame, c: ColumnOrName, value, cast: str | None = None) -> DataFrame:
    """Equality filter; a text column compared to a number is cast with
    ``try_cast`` so malformed text is simply unequal (ANSI cast would fail)."""
    col = _c(c)
    if cast:
        col = col.try_cast(cast)
    return df.where(col == F.lit(value))


def where_range(df: DataFrame, c: ColumnOrName, low=None, high=None,
                low_inclusive: bool = False, high_inclusive: bool = False) -> DataFrame:
    """Open or closed range filter."""
    col = _c(c)
    cond = F.lit(True)
    if low is not None:
        cond = cond & ((col >= low) if low_inclusive else (col > low))
    if high is not None:
        cond = cond & ((col <= high) if high_inclusive else (col < high))
    return df.where(cond)


def where_contains(df: DataFrame, c: ColumnOrName, needle: str) -> DataFrame:
    """P5: keep rows whose text holds ``needle``."""
    return df.where(F.contains(_c(c), F.lit(needle)))


def where_not_contains(df: DataFrame, c: ColumnOrName, needle: str) -> DataFrame:
    """Drop rows whose text holds ``needle`` (e.g. a header marker).

    Null text is kept out, as ``NOT contains(null)`` is null.
    """
    return df.where(~F.contains(_c(c), F.lit(needle)))


def drop_prefixed(df: DataFrame, c: ColumnOrName, prefixes: Sequence[str]) -> DataFrame:
    """Drop header and junk lines by prefix."""
    col = _c(c)
    hit = None
    for p in prefixes:
        h = col.startswith(p)
        hit = h if hit is None else (hit | h)
    return df if hit is None else df.where(~hit)


def drop_header(df: DataFrame, c: ColumnOrName, header: str | Column) -> DataFrame:
    """Drop every line equal to the header (one copy per input file).

    The header is given (or is a scalar subquery), never fetched with
    ``first()``: input order is not defined across files.
    """
    h = header if isinstance(header, Column) else F.lit(header)
    return df.where(_c(c) != h)
