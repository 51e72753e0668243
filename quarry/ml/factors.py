"""ALS models as tables: factors as frames, predictions by joins.

A model's own ``transform`` joins the same way but gives a Scala function per
row; here the factors are written once, and the dot product is a built-in
expression. Each join has one row per user (item) on the factor side, so a user
holding a third of all ratings only makes one partition of the rating side
large, which AQE splits (not for a hot item where ``score_pairs`` and the model
join the items in one stage: one task streams its pairs, without holding them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.layout import written


def factor_tables(model) -> tuple[DataFrame, DataFrame]:
    """(id, factors) of users and of items, written once."""
    return tuple(written(f.select("id", F.col("features").alias("factors")), name)
                 for f, name in ((model.userFactors, "user-factors"), (model.itemFactors, "item-factors")))


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str, name: str = "prediction",
                between: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``pairs`` with ``known`` (both sides have factors) and the dot product of
    their factors, summed in order as single-precision products like the
    model's own; NaN for a cold pair.

    ``between`` is applied to the pairs when the users are joined and the items
    are not; it keeps all rows and columns and may add some. A model's own
    ``transform``, which joins by user and then by item too, leaves the pairs
    dealt by item, so that both predictions share that shuffle, the largest one:
    the two copies of a user's factors that a pair carries in it are equal and
    compress to one."""
    u = users.select(F.col("id").alias("_u"), F.col("factors").alias("_uf"))
    i = items.select(F.col("id").alias("_i"), F.col("factors").alias("_if"))
    by_user = pairs.join(u, F.col(user) == F.col("_u"), "left").drop("_u")
    by_user = between(by_user) if between else by_user
    both = by_user.join(i, F.col(item) == F.col("_i"), "left")
    known = F.col("_uf").isNotNull() & F.col("_if").isNotNull()
    product = F.aggregate(F.zip_with("_uf", "_if", lambda a, b: (a * b).cast("float")), F.lit(0.0).cast("float"), lambda s, x: (s + x).cast("float"))
    return both.select(*[F.col(f"`{c}`") for c in by_user.columns if c != "_uf"], known.alias("known"),
                       F.when(known, product).otherwise(F.lit(float("nan")).cast("float")).alias(name))


def rating_error(scored: DataFrame, rating: str, prediction: str = "prediction") -> DataFrame:
    """One row: known pairs, cold pairs, and the root mean square error over the known ones."""
    miss = F.when(F.col("known"), F.col(rating) - F.col(prediction))
    return scored.agg(F.count_if("known").alias("known_pairs"), F.count_if(~F.col("known")).alias("cold_pairs"), F.sqrt(F.avg(miss * miss)).alias("rmse"))
