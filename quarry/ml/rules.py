"""Fitted trees and forests as tables and as SQL.

A model's node table is what Spark itself writes when the model is saved, read
back as a frame; the predicates come from it. A tree of depth d has at most
2^(d + 1) - 1 nodes, so the rules are bounded by the model's own parameters,
not by the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def node_table(spark: SparkSession, model) -> DataFrame:
    """(tree, weight, id, is_leaf, feature, threshold, prediction, counts, gain, left, right), one row per node of a decision tree or forest."""
    path = scratch_path(spark, "models", f"tree-{uuid.uuid4().hex[:12]}")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:  # a forest: nodes below their tree's number
        node, tree = F.col("nodeData"), F.col("treeID")
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("_t", "_about", "weight").drop("_about")
        data = data.join(F.broadcast(weights), tree == F.col("_t"))  # one row per tree
    else:
        node, tree = F.struct(*[F.col(c) for c in data.columns]), F.lit(0)
        data = data.withColumn("weight", F.lit(1.0))
    n = lambda f: node.getField(f)
    split = n("split")
    return data.select(tree.cast("int").alias("tree"), F.col("weight").cast("double").alias("weight"), n("id").alias("id"), (n("leftChild") < 0).alias("is_leaf"),
                       F.when(n("leftChild") >= 0, split.getField("featureIndex")).alias("feature"),
                       F.when(n("leftChild") >= 0, split.getField("leftCategoriesOrThreshold")[0]).alias("threshold"),
                       n("prediction").alias("prediction"), n("impurityStats").alias("counts"), n("gain").alias("gain"),
                       n("leftChild").alias("left"), n("rightChild").alias("right"))


def _literal(x: float) -> str:
    """A double that any engine reads back exactly."""
    return f"CAST('{x!r}' AS DOUBLE)"


def _case(nodes: dict, at: int, feature: str, leaf) -> str:
    n = nodes[at]
    if n.is_leaf:
        return leaf(n)
    test = f"{feature.format(n.feature, n.feature + 1)} <= {_literal(n.threshold)}"
    return f"CASE WHEN {test} THEN {_case(nodes, n.left, feature, leaf)} ELSE {_case(nodes, n.right, feature, leaf)} END"


def tree_sql(nodes: DataFrame, feature: str = "features[{1}]", tree: int = 0) -> str:
    """A tree's prediction as one CASE expression. ``feature`` says how a
    component is written: ``{0}`` is its number from 0, ``{1}`` from 1."""
    rows = {r.id: r for r in nodes.where(F.col("tree") == tree).collect()}
    return _case(rows, 0, feature, lambda n: _literal(n.prediction))


def forest_sql(nodes: DataFrame, feature: str = "features[{1}]") -> tuple[list[str], str]:
    """A forest's prediction as (votes, pick). Votes are one expression
    per class: the sum over the trees of the class's share in the row's leaf.
    ``pick`` reads them as ``v0``, ``v1``, ..: the class of the greatest sum, the first one on ties."""
    rows: dict = {}
    for r in nodes.collect():
        rows.setdefault(r.tree, {})[r.id] = r
    classes = len(rows[min(rows)][0].counts)

    def share(k):
        return lambda n: _literal(n.counts[k] / sum(n.counts) if sum(n.counts) else 0.0)

    votes = [" + ".join(f"({_case(t, 0, feature, share(k))})" for _, t in sorted(rows.items())) for k in range(classes)]
    best = "greatest(" + ", ".join(f"v{k}" for k in range(classes)) + ")"
    return votes, "CASE " + " ".join(f"WHEN v{k} = {best} THEN {_literal(float(k))}" for k in range(classes)) + " END"


def tree_walk(df: DataFrame, nodes: DataFrame, features: str, depth: int, keep: list[str]) -> DataFrame:
    """Predictions from the node table alone: every row starts at the roots and
    takes ``depth`` joins down (nodes are few; AQE broadcasts them by size).
    Returns keep + (tree, prediction, counts) rows, one per row and tree."""
    node = nodes.select(*[F.col(c).alias(f"_{c}") for c in nodes.columns])
    at = df.select(*keep, features).join(node.where("_id = 0"), how="cross")  # one row per tree
    for _ in range(depth):
        go = F.when(F.col("_is_leaf"), F.col("_id")).when(F.col(features)[F.col("_feature")] <= F.col("_threshold"), F.col("_left")).otherwise(F.col("_right"))
        step = at.select(*keep, features, F.col("_tree").alias("_of"), go.alias("_go"))
        at = step.join(node, (F.col("_of") == F.col("_tree")) & (F.col("_go") == F.col("_id")))
    return at.select(*keep, F.col("_tree").alias("tree"), F.col("_prediction").alias("prediction"), F.col("_counts").alias("counts"))
