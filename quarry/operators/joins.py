"""Joins.

Only code lists whose size the program itself fixes are broadcast on request.
Every other side is left to Catalyst and AQE, which go by bytes: a stored table
by its size on disk, a derived one by its real shuffled size, under
``spark.sql.autoBroadcastJoinThreshold`` and its adaptive variant. No job runs
while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def join_on(left: DataFrame, right: DataFrame, left_key: str | Sequence[str],
            right_key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on differently named keys; both key columns are kept."""
    lk = [left_key] if isinstance(left_key, str) else list(left_key)
    rk = [right_key] if isinstance(right_key, str) else list(right_key)
    cond = None
    for a, b in zip(lk, rk):
        c = left[a] == right[b]
        cond = c if cond is None else (cond & c)
    return left.join(right, cond, how)


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           how: str = "inner", keep_key: bool = False, fixed_size: bool = False) -> DataFrame:
    """Code -> name enrichment; the lookup key is dropped afterwards.

    The lookup key is cast once to the fact key's type (a string code joined
    to a double column must not rely on implicit coercion). ``how='left'``
    keeps facts with unknown codes (null names); ``inner`` drops them.
    ``fixed_size`` marks a code table whose size the program fixes (an inline
    list): it is broadcast.
    """
    ftype = fact.schema[fact_key].dataType.simpleString()
    d = dim.withColumn(dim_key, F.col(dim_key).try_cast(ftype))
    d = F.broadcast(d) if fixed_size else d
    out = fact.join(d, fact[fact_key] == d[dim_key], how)
    return out if keep_key else out.drop(d[dim_key])


def unmatched(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
              fixed_size: bool = False) -> DataFrame:
    """Facts whose code has no lookup row (the rows an inner lookup loses)."""
    ftype = fact.schema[fact_key].dataType.simpleString()
    d = dim.select(F.col(dim_key).try_cast(ftype).alias("__k"))
    d = F.broadcast(d) if fixed_size else d
    return fact.join(d, fact[fact_key] == d["__k"], "left_anti")


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Replicate the values of a one-row frame (a global aggregate) to
    every row, as scalar subqueries; no join is planned. Subqueries over the
    same aggregate are merged by Spark (z-scores of two columns, four
    subqueries, ran as one extra job)."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def scalar(df: DataFrame, expr: Column) -> Column:
    """J5, single value: a scalar subquery Catalyst evaluates once."""
    return df.select(expr).scalar()
