"""String column functions.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen. Delimiters are literal text, escaped before they reach ``split``
(which takes a regular expression).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper(c: ColumnOrName) -> Column:
    """upper-case a line or one field."""
    return F.upper(_c(c))


def replace_all(c: ColumnOrName, old: str, new: str) -> Column:
    """literal (not regex) replacement of every match."""
    return F.replace(_c(c), F.lit(old), F.lit(new))


def split_literal(c: ColumnOrName, sep: str, limit: int = -1) -> Column:
    """``split`` on a literal delimiter; keeps trailing empty fields."""
    return F.split(_c(c), re.escape(sep), limit)


def field(c: ColumnOrName, sep: str, n: int) -> Column:
    """field ``n`` (0-based) of a delimited line; null when out of range."""
    return F.get(split_literal(c, sep), n)


def join_fields(cols: list[ColumnOrName], sep: str) -> Column:
    """join fields with a delimiter."""
    return F.concat_ws(sep, *[_c(x) for x in cols])


def tokens_regex(c: ColumnOrName, pattern: str) -> Column:
    """Tokens of a line split on a regular expression, with the JVM
    ``String.split`` rule: trailing empty tokens are dropped, so a line made
    only of separators has no token, while the empty line has one empty
    token. Inner and leading empty tokens are kept."""
    col = _c(c)
    stripped = F.regexp_replace(col, f"(?:{pattern})+\\z", "")
    empty = F.array().cast("array<string>")
    return (F.when(col.isNull(), F.lit(None).cast("array<string>"))
            .when((stripped == "") & (col != ""), empty)
            .otherwise(F.split(stripped, pattern)))


def tokens(c: ColumnOrName, sep: str) -> Column:
    """tokens of a line split on a literal separator (JVM rule)."""
    return tokens_regex(c, re.escape(sep))


def explode_words(arr: Column, name: str) -> list:
    """(explode expression, filter) for one row per array element.

    ``explode_outer`` plus a null filter gives the same rows as ``explode``
    but keeps Spark from inferring a ``size(array) > 0`` filter and pushing
    it, with the whole tokenising, below a repartition into the scan task.
    """
    return [F.explode_outer(arr).alias(name), F.col(name).isNotNull()]


def explode_tokens(df, c: ColumnOrName, sep: str, name: str = "token"):
    """F19 as a table: one row per token, other columns kept."""
    gen, keep = explode_words(tokens(c, sep), name)
    return df.select("*", gen).where(keep)
