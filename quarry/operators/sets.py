"""Set operations, ordering, top-k and repeatable splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _c, ColumnOrName


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name, then distinct."""
    return a.unionByName(b).distinct()


def intersect_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set intersection (duplicates removed)."""
    return a.intersect(b)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """L2: first ``k`` rows by an explicit total order (ties broken by the
    caller's last key) so the answer is repeatable. Planned as
    ``TakeOrderedAndProject``: each task keeps k rows, no global sort."""
    return df.orderBy(*order).limit(k)


def split_bucket(keys: Sequence[ColumnOrName], seed: int = 42, buckets: int = 1000,
                 method: str = "xxhash64") -> Column:
    """A stable bucket in [0, buckets) from a hash of the row's key.

    ``xxhash64`` is the fast default. ``md5`` hashes the text
    ``seed|key1|key2...`` and takes its first 32 bits: slower, but any engine
    with md5 can tell which side a row falls on (e.g. a SQL warehouse)."""
    if method == "md5":
        text = F.concat_ws("|", F.lit(str(seed)), *[_c(k).cast("string") for k in keys])
        first32 = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        return F.pmod(first32, F.lit(buckets))
    return F.pmod(F.xxhash64(F.lit(seed), *[_c(k) for k in keys]), F.lit(buckets))


def split_by_key(df: DataFrame, keys: Sequence[ColumnOrName], train_fraction: float = 0.7,
                 seed: int = 42, side_name: str | None = None, method: str = "xxhash64"):
    """Repeatable train/test split.

    A row's side depends only on its key and the seed, never on partitioning
    or task order (``randomSplit`` does depend on them), and the parts are
    disjoint and complete. With ``side_name`` the frame comes back whole with
    a side column; otherwise as (train, test).
    """
    cut = int(round(train_fraction * 1000))
    in_train = split_bucket(keys, seed, method=method) < F.lit(cut)
    if side_name:
        return df.withColumn(side_name, F.when(in_train, F.lit("train")).otherwise(F.lit("test")))
    return df.where(in_train), df.where(~in_train)
