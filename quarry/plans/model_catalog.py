"""Registered queries of models taken apart into tables and SQL."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import factors as fa
from ..ml import features as fe
from ..ml import models as mo
from ..ml import rules as ru
from ..operators import layout, sets
from .catalog import query
from .ml_catalog import _TOKENS, SEED, _embeddings
from .tables import table

BUCKETS = 1024  # few enough that terms collide


@query("ml_hashed_tf")
def q_ml_hashed_tf(spark, d):
    """M7: hashed term frequencies of every document, collisions added up."""
    docs = fe.tokenize(fe.by_document(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text"), "text")
    return fe.bucket_frequencies(docs, "doc_id", "tokens", BUCKETS)


@query("ml_hashed_vectors")
def q_ml_hashed_vectors(spark, d):
    """M7 as one sparse vector per document."""
    docs = fe.tokenize(fe.by_document(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text"), "text")
    return fe.sparse_rows(fe.bucket_frequencies(docs, "doc_id", "tokens", BUCKETS), "doc_id", BUCKETS).select(
        "doc_id", F.size("indices").cast("bigint").alias("filled"), F.array_join("indices", ",").alias("indices"), F.array_join("values", ",").alias("values"))


def _split(spark, d):
    emb = _embeddings(spark, d).withColumn("label", F.col("label").cast("double"))
    return sets.split_by_key(emb, ["vec_id"], 0.7, seed=SEED, method="md5")


@query("ml_tree_rules")
def q_ml_tree_rules(spark, d):
    """For every test row, whether the tree's own prediction, its CASE
    expression and a walk over its node table agree."""
    train, test = _split(spark, d)
    model = mo.decision_tree(train, max_depth=4, seed=SEED)
    nodes = layout.written(ru.node_table(spark, model), "tree-nodes")
    rows = model.transform(test).select("vec_id", F.col("prediction").alias("own"), vector_to_array("features").alias("x"))
    walked = ru.tree_walk(rows, nodes, "x", model.depth, ["vec_id"]).select(F.col("vec_id").alias("_v"), F.col("prediction").alias("walked"))
    by_case = F.expr(ru.tree_sql(nodes, "x[{0}]"))
    both = rows.withColumn("by_case", by_case).join(walked, F.col("vec_id") == F.col("_v"), "left")
    return both.select("vec_id", ((F.col("own") == F.col("by_case")) & F.col("own").eqNullSafe(F.col("walked"))).alias("agree"))


@query("ml_forest_rules")
def q_ml_forest_rules(spark, d):
    """For every test row, whether the forest and its exported votes agree."""
    train, test = _split(spark, d)
    model = mo.random_forest(train, seed=SEED)
    votes, pick = ru.forest_sql(ru.node_table(spark, model), "x[{0}]")
    rows = model.transform(test).select("vec_id", F.col("prediction").alias("own"), vector_to_array("features").alias("x"))
    counted = rows.select("vec_id", "own", *[F.expr(v).alias(f"v{k}") for k, v in enumerate(votes)])
    return counted.select("vec_id", (F.col("own") == F.expr(pick)).alias("agree"))


def _ratings(spark, d):
    """(user, item, rating, user_id, item_id): mean quantity per customer and part, their keys numbered too, as ALS takes
    int ids and keys may be larger. Customers are numbered on the orders, which are fewer than the ratings, and no ratings
    are written only to number their keys. Written: read by the fit and by the prediction. (``ml_als`` numbers the keys of
    its ratings: its predictions depend on the numbers, whether pairs are known or agree here does not.)"""
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"), "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    o = o.join(fe.dense_ids(o, "user", "user_id"), "user")
    ratings = li.join(o, li["l_orderkey"] == o["o_orderkey"]).groupBy("user", "user_id", "item").agg(F.avg("l_quantity").alias("rating"))
    return layout.written(ratings.join(fe.dense_ids(li, "item", "item_id"), "item"), "ratings-numbered")


@query("ml_als_scores")
def q_ml_als_scores(spark, d):
    """The held-out ratings scored by joins on the factor tables: known
    pairs agree with the model's own prediction, cold pairs are told apart."""
    train, test = sets.split_by_key(_ratings(spark, d), ["user", "item"], 0.5, seed=SEED, method="md5")
    model = mo.als(train, "user_id", "item_id", "rating", rank=10, max_iter=3, seed=SEED)
    users, items = fa.factor_tables(model)
    scored = fa.score_pairs(test, users, items, "user_id", "item_id", between=lambda pairs: model.transform(pairs).withColumnRenamed("prediction", "own"))
    near = F.abs(F.col("own") - F.col("prediction")) <= 1e-4 * F.greatest(F.lit(1.0), F.abs("own"))
    return scored.select("user", "item", "known", F.when(F.col("known"), near).otherwise(F.isnan("own") & F.isnan("prediction")).alias("agree"))


_MD5 = "CAST(('0x' || substr(md5({0}), 1, 8)) AS BIGINT)"
_BUCKETED = f"""t AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents),
             c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
             b AS (SELECT doc_id, {_MD5.format('term')} % {BUCKETS} AS bucket, sum(tf)::BIGINT AS tf, count(*) AS terms FROM c GROUP BY ALL)"""
_IN_TEST = f"{_MD5.format(chr(39) + str(SEED) + '|' + chr(39) + ' || vec_id::VARCHAR')} % 1000 >= 700"

ORACLES = {
    "ml_hashed_tf": f"WITH {_BUCKETED} SELECT doc_id, bucket, tf, terms FROM b",
    "ml_hashed_vectors": f"""
        WITH {_BUCKETED}
        SELECT doc_id, count(*) AS filled, string_agg(bucket::VARCHAR, ',' ORDER BY bucket) AS indices, string_agg(tf::VARCHAR, ',' ORDER BY bucket) AS values
        FROM b GROUP BY doc_id""",
    "ml_tree_rules": f"SELECT vec_id, true AS agree FROM embeddings WHERE {_IN_TEST}",
    "ml_forest_rules": f"SELECT vec_id, true AS agree FROM embeddings WHERE {_IN_TEST}",
    "ml_als_scores": f"""
        WITH r AS (SELECT DISTINCT o_custkey AS "user", l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
             s AS (SELECT *, {_MD5.format(f"concat_ws('|', '{SEED}', r.user, item)")} % 1000 < 500 AS train FROM r)
        SELECT "user", item, "user" IN (SELECT "user" FROM s WHERE train) AND item IN (SELECT item FROM s WHERE train) AS known, true AS agree
        FROM s WHERE NOT train""",
}
