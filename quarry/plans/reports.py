"""Report plans over the order tables (the credit-report shape of SURVEY 2.5 A9).

Catalyst does not push an aggregate below a join, so the plans here do it:
line items are reduced to one row per order before they meet ``orders``, and
orders to one row per customer before they meet ``customer``. Each shuffle
then moves a fraction of the fact rows, the per-order aggregate is already
hash-partitioned on the join key (no second exchange on that side), and a
hot order or customer is reduced map-side before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import rate_report


def lines_per_order(lineitem: DataFrame, flag: Column) -> DataFrame:
    """(l_orderkey, lines, flagged) - one row per order."""
    return (lineitem.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("lines"), F.count_if(flag).alias("flagged")))


def segment_rates(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                  flag: Column | None = None, keys: Sequence[str] = ("c_mktsegment",),
                  order_keys: Sequence[str] = ()) -> DataFrame:
    """Line items, flagged line items and the rounded percentage per customer
    attribute (and optionally per order attribute): the lineitem -> orders ->
    customer rate report.

    The line items are reduced per order and the orders per customer before
    each join, so every shuffle carries partial aggregates. ``order_keys`` are
    columns of ``orders`` to group by as well (e.g. the order priority).
    """
    flag = F.col("l_returnflag") == F.lit("R") if flag is None else flag
    o = orders.select("o_orderkey", "o_custkey", *order_keys)
    c = customer.select("c_custkey", *keys)
    per_order = lines_per_order(lineitem, flag)
    per_cust = (per_order.join(o, per_order["l_orderkey"] == o["o_orderkey"])
                .groupBy("o_custkey", *order_keys)
                .agg(F.sum("lines").alias("lines"), F.sum("flagged").alias("flagged")))
    joined = per_cust.join(c, per_cust["o_custkey"] == c["c_custkey"])
    return rate_report(joined, [*keys, *order_keys], F.col("flagged"), weight=F.col("lines"))
