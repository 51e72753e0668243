"""Numeric parsing and derivation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .recode import full_match
from .text import _c, ColumnOrName

# The two number tests of the studied programs.
INT_TEST = r"\d*"  # full match; matches the empty string too
FLOAT_TEST = r"[+-]?(([1-9][0-9]*)|(0))([.,][0-9]+)?"  # full match; ',' may be the decimal mark


def parse_int_or_zero(c: ColumnOrName, fallback: Column | None = None) -> Column:
    """the value when it is all digits, else ``fallback`` when that is, else 0.

    The empty string passes the test but is no number; it counts as 0.
    """
    col = _c(c)
    as_int = lambda x: F.coalesce(x.try_cast("bigint"), F.lit(0).cast("bigint"))
    expr = F.when(full_match(col, INT_TEST), as_int(col))
    if fallback is not None:
        expr = expr.when(full_match(fallback, INT_TEST), as_int(fallback))
    return expr.otherwise(F.lit(0).cast("bigint"))


def parse_float(c: ColumnOrName) -> Column:
    """F10 test + cast: null unless the whole value is a number by the float test."""
    col = _c(c)
    return F.when(full_match(col, FLOAT_TEST),
                  F.replace(col, F.lit(","), F.lit(".")).try_cast("double"))


def parse_float_or_zero(c: ColumnOrName, fallback: Column | None = None) -> Column:
    """value, else fallback field, else 0.0."""
    expr = parse_float(c)
    if fallback is not None:
        expr = F.coalesce(expr, parse_float(fallback))
    return F.coalesce(expr, F.lit(0.0))


def round_half_up(c: ColumnOrName, step: float) -> Column:
    """JVM ``Math.round(x / step) * step`` = ``floor(x / step + 0.5) * step``.

    Not ``round()``: that rounds half away from zero, which differs for
    negative halves (-2.5 -> -3 instead of -2).
    """
    return F.floor(_c(c) / F.lit(float(step)) + F.lit(0.5)) * F.lit(float(step))


def cap(c: ColumnOrName, maximum: float) -> Column:
    """cap at a maximum."""
    return F.least(_c(c), F.lit(maximum))


def row_mean_abs(cols: Sequence[ColumnOrName]) -> Column:
    """``abs((c1 + ... + ck) / k)``."""
    total = None
    for x in cols:
        total = _c(x) if total is None else total + _c(x)
    return F.abs(total / F.lit(float(len(cols))))


def ratio_pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    """F16: ``num / (den + 1) * 100``; the +1 keeps a zero denominator finite."""
    return _c(num) / (_c(den) + F.lit(1)) * F.lit(100)


def rounded_pct(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``round(part * 100 / whole)`` (half up, 0 decimals)."""
    return F.round(_c(part) * F.lit(100) / _c(whole), 0)
