"""Registered ML queries.

Keys with a closed form (z-scores, indexes, tokens, exact TF-IDF, one-feature
regression, accuracy, R2) carry DuckDB oracles; fitted models with random
starts (trees, forests, naive Bayes, k-means, PCA, ALS) are checked by row
count here and by planted-data tests in ``tests/test_ml.py``.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import MinMaxScaler
from pyspark.sql import functions as F

from ..ml import features as fe
from ..ml import models as mo
from ..operators import aggregates as agg
from ..operators import layout, sets
from .catalog import _rule_predictions, query, r6
from .tables import table

SEED = 42


def _embeddings(spark, d):
    return fe.array_features(table(spark, d, "embeddings"), "embedding").drop("embedding")


def _labels(spark, d):
    return table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))


def _labelled_docs(spark, d):
    """Labelled documents only, then by document: where the join had to
    shuffle, its partitioning is kept and no second exchange is planned."""
    return table(spark, d, "documents").select("doc_id", "text").join(_labels(spark, d), "doc_id").repartition("doc_id")


@query("ml_assemble")
def q_ml_assemble(spark, d):
    cols = ["l_quantity", "l_discount", "l_tax"]
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", *cols)
    v = fe.assemble(li, cols).select("l_orderkey", "l_linenumber",
                                     F.col("l_extendedprice").alias("label"), "features")
    # the vector's elements as plain columns (sinks and SQL read them)
    return fe.vector_columns(v, "features", [f"x_{c}" for c in cols])


@query("zscore")
def q_zscore(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    z = fe.zscore_columns(part, ["p_size", "p_retailprice"])
    return z.select("p_partkey", r6(F.col("p_size_z")).alias("z_size"),
                    r6(F.col("p_retailprice_z")).alias("z_price"))


@query("ml_scale")
def q_ml_scale(spark, d):
    cols = ["l_quantity", "l_discount", "l_tax"]
    v = fe.assemble(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *cols), cols)
    scaled, _ = fe.scale_vectors(v, "features", "scaled")
    arr = vector_to_array("scaled")
    return scaled.select("l_orderkey", "l_linenumber",
                         *[r6(arr[i]).alias(f"z_{c}") for i, c in enumerate(cols)])


@query("string_index")
def q_string_index(spark, d):
    """M3's fitted labels as a table: (category, index)."""
    return fe.label_ranks(table(spark, d, "events").select("event_type"), "event_type").withColumnRenamed("label", "event_type")


@query("index_to_string")
def q_index_to_string(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type")
    labels = fe.label_ranks(ev, "event_type")
    indexed = fe.index_labels(ev, "event_type", "event_index", labels)
    return fe.labels_back(indexed, "event_index", "event_type_back", labels).select("event_id", "event_index", "event_type_back")


@query("ml_tokenize")
def q_ml_tokenize(spark, d):
    docs = fe.tokenize(table(spark, d, "documents").select("doc_id", "text"), "text")
    return (docs.select("doc_id", F.posexplode_outer("tokens").alias("pos", "token"))
            .where(F.col("token").isNotNull()))


@query("ml_tfidf")
def q_ml_tfidf(spark, d):
    # by document once: the counts per (document, term) then need no exchange of their own
    docs = fe.tokenize(fe.by_document(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text"), "text")
    n_docs = table(spark, d, "documents").select(F.count(F.lit(1))).scalar()
    t = fe.tfidf_long(docs, "doc_id", "tokens", n_docs=n_docs)
    return t.select("doc_id", "term", "tf", r6(F.col("idf")).alias("idf"), r6(F.col("tfidf")).alias("tfidf"))


@query("ml_text_classifier")
def q_ml_text_classifier(spark, d):
    labelled = _labelled_docs(spark, d)
    train, test = sets.split_by_key(labelled, ["doc_id"], 0.7, seed=SEED)
    model = mo.fit_text_classifier(train, "text", "label")
    return agg.confusion_matrix(model.transform(test), "label", "prediction")


@query("ml_naive_bayes")
def q_ml_naive_bayes(spark, d):
    # hashed counts learn nothing: written once, then read by both fits and the prediction
    counted = fe.hashed_tf(fe.tokenize(_labelled_docs(spark, d), "text")).select("doc_id", "label", "_tf")
    train, test = sets.split_by_key(layout.written(counted, "hashed-tf"), ["doc_id"], 0.7, seed=SEED)
    idf = fe.fit_idf(train)  # sees the training part only
    model = mo.naive_bayes(idf.transform(train), "tfidf", "label")
    return mo.with_predictions(model, idf.transform(test), ["doc_id", "label"])


def _long_counts(spark, d):
    """Labelled documents (doc_id, label) and their (doc_id, label, term, tf) rows, written once."""
    labelled = fe.by_document(table(spark, d, "documents").select("doc_id", "text").join(_labels(spark, d), "doc_id"), "doc_id", "text")
    counts = fe.term_frequencies(fe.tokenize(labelled, "text"), "doc_id", "tokens", also=("label",))
    ids = table(spark, d, "documents").select("doc_id").join(_labels(spark, d), "doc_id")
    return ids, layout.written(counts, "tf")


@query("ml_tfidf_split")
def q_ml_tfidf_split(spark, d):
    """M8 as studied: document frequencies from the training part only, applied to the test part."""
    docs = fe.by_document(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")
    tf = layout.written(fe.term_frequencies(fe.tokenize(docs, "text"), "doc_id", "tokens"), "tf")
    train, test = sets.split_by_key(tf, ["doc_id"], 0.7, seed=SEED, method="md5")
    ids, _ = sets.split_by_key(table(spark, d, "documents").select("doc_id"), ["doc_id"], 0.7, seed=SEED, method="md5")
    n_train = ids.select(F.count(F.lit(1))).scalar()
    idf = fe.inverse_document_frequency(train, "doc_id", n_train)
    value = F.coalesce(F.col("idf"), F.log(n_train + F.lit(1)))  # a term unseen in training
    return test.join(idf, "term", "left").select("doc_id", "term", "tf", r6(value).alias("idf"), r6(F.col("tf") * value).alias("tfidf"))


@query("ml_nb_terms")
def q_ml_nb_terms(spark, d):
    """M13 exactly: multinomial naive Bayes on unhashed term counts, fitted on
    the training part, applied to the test part."""
    (train, test), (train_tf, test_tf) = (sets.split_by_key(f, ["doc_id"], 0.7, seed=SEED, method="md5")
                                          for f in _long_counts(spark, d))
    terms, priors = mo.term_naive_bayes(train_tf, train, "label", [0.0, 1.0])
    s = mo.term_scores(test_tf, test, "doc_id", terms, priors, 2)
    margin = F.col("score_1") - F.col("score_0")
    return s.select("doc_id", "label", F.when(margin > 0, 1.0).otherwise(0.0).alias("prediction"), F.round(margin, 4).alias("margin"))


@query("ml_linreg")
def q_ml_linreg(spark, d):
    li = fe.assemble(table(spark, d, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity"])
    model = mo.linear_regression(li, "features", "l_extendedprice")
    facts = mo.regression_facts(spark, model)
    return facts.select(F.round(F.col("coefficients")[0], 4).alias("slope"),
                        F.round("intercept", 2).alias("intercept"))


@query("eval_r2_linreg")
def q_eval_r2_linreg(spark, d):
    """M17 over a fitted model's own predictions."""
    li = fe.assemble(table(spark, d, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity"])
    model = mo.linear_regression(li, "features", "l_extendedprice")
    pred = model.transform(li).select("l_extendedprice", "prediction")
    return mo.r2(pred, "l_extendedprice", "prediction").select(r6(F.col("r2")).alias("r2"))


@query("ml_pca")
def q_ml_pca(spark, d):
    out, _ = fe.pca(_embeddings(spark, d), "features", 3)
    return fe.vector_columns(out.select("vec_id", "pca"), "pca", ["pc1", "pc2", "pc3"])


@query("ml_kmeans")
def q_ml_kmeans(spark, d):
    emb = _embeddings(spark, d)
    model = mo.kmeans(emb, "features", k=4, seed=1)
    return model.transform(emb).select("vec_id", F.col("prediction").alias("cluster"))


def _split_embeddings(spark, d):
    emb = _embeddings(spark, d).withColumn("label", F.col("label").cast("double"))
    return sets.split_by_key(emb, ["vec_id"], 0.7, seed=SEED)


@query("ml_tree")
def q_ml_tree(spark, d):
    train, test = _split_embeddings(spark, d)
    model = mo.decision_tree(train, max_depth=4, seed=SEED)
    return mo.with_predictions(model, test, ["vec_id", "label"])


@query("ml_forest")
def q_ml_forest(spark, d):
    train, test = _split_embeddings(spark, d)
    model = mo.random_forest(train, seed=SEED)
    return mo.with_predictions(model, test, ["vec_id", "label"])


@query("ml_compare")
def q_ml_compare(spark, d):
    train, test = _split_embeddings(spark, d)
    # naive Bayes needs features >= 0: min-max scale, fitted on the training part
    scaler = MinMaxScaler(inputCol="features", outputCol="features01").fit(train)
    scaled = [fe.at_least_zero(scaler.transform(part), "features01") for part in (train, test)]
    return mo.compare_classifiers(*scaled, mo.default_classifiers(seed=SEED, nb_features="features01"))


@query("ml_als")
def q_ml_als(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    ratings = layout.written(li.join(o, li["l_orderkey"] == o["o_orderkey"])
                             .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
                             .agg(F.avg("l_quantity").alias("rating")), "ratings")
    # ALS takes int ids; keys may be larger. Written: read by the fit and by the prediction
    numbered = layout.written(ratings.join(fe.dense_ids(ratings, "user", "user_id"), "user")
                              .join(fe.dense_ids(ratings, "item", "item_id"), "item"), "ratings-numbered")
    train, test = sets.split_by_key(numbered, ["user", "item"], 0.9, seed=SEED)
    model = mo.als(train, "user_id", "item_id", "rating", rank=10, max_iter=5, seed=SEED)
    return model.transform(test).select("user", "item", "rating", "prediction")


@query("eval_accuracy")
def q_eval_accuracy(spark, d):
    return mo.accuracy(_rule_predictions(spark, d), "quality", "prediction").select(
        r6(F.col("accuracy")).alias("accuracy"))


@query("eval_r2")
def q_eval_r2(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", "l_quantity")
    # prediction = mean quantity of the row's flag; computed from per-flag
    # moments, so no row is joined back on the (three-valued) flag
    return mo.r2_of_group_means(li, "l_quantity", ["l_returnflag"]).select(r6(F.col("r2")).alias("r2"))


# ML's Tokenizer = JVM lower-case + split on one \s character (trailing
# empty tokens dropped); \s in the JVM also covers the vertical tab.
_WS = r"[ \t\n\x0B\f\r]"
_LOW = f"regexp_replace(lower(text), '{_WS}+$', '')"
_TOKENS = (f"CASE WHEN text = '' THEN [''] WHEN {_LOW} = '' THEN []::VARCHAR[] "
           f"ELSE regexp_split_to_array({_LOW}, '{_WS}') END")

_IN_TRAIN = ("CAST(('0x' || substr(md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR))), 1, 8)) AS BIGINT) % 1000 < 700")

ORACLES: dict[str, str] = {
    "ml_tfidf_split": f"""
        WITH t AS (SELECT doc_id, {_IN_TRAIN} AS train, unnest({_TOKENS}) AS term FROM documents),
             tf AS (SELECT doc_id, train, term, count(*) AS tf FROM t GROUP BY ALL),
             n AS (SELECT count(*) + 1.0 AS n FROM documents WHERE {_IN_TRAIN}),
             df AS (SELECT term, count(*) AS df FROM tf WHERE train GROUP BY term),
             w AS (SELECT doc_id, tf.term, tf, ln(n / (coalesce(df, 0) + 1.0)) AS idf
                   FROM tf CROSS JOIN n LEFT JOIN df ON tf.term = df.term WHERE NOT train)
        SELECT doc_id, term, tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf FROM w""",
    "ml_nb_terms": f"""
        WITH d AS (SELECT doc_id, text, CAST(quality AS DOUBLE) AS label,
                          {_IN_TRAIN} AS train FROM documents JOIN labels USING (doc_id)),
             t AS (SELECT doc_id, label, train, unnest({_TOKENS}) AS term FROM d),
             c AS (SELECT term, count(*) FILTER (label = 0) + 1.0::DOUBLE AS n0,
                          count(*) FILTER (label = 1) + 1.0::DOUBLE AS n1 FROM t WHERE train GROUP BY term),
             s AS (SELECT sum(n0) AS t0, sum(n1) AS t1 FROM c),
             p AS (SELECT ln((count(*) FILTER (label = 1) + 1.0) / (count(*) FILTER (label = 0) + 1.0)) AS m
                   FROM d WHERE train),
             x AS (SELECT doc_id, sum(ln(n1 / t1) - ln(n0 / t0)) AS m
                   FROM t JOIN c USING (term) CROSS JOIN s WHERE NOT train GROUP BY doc_id),
             y AS (SELECT d.doc_id, label, p.m + coalesce(x.m, 0) AS margin
                   FROM d CROSS JOIN p LEFT JOIN x ON x.doc_id = d.doc_id WHERE NOT train)
        SELECT doc_id, label, CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
               round(margin, 4) AS margin FROM y""",
    "eval_r2_linreg": "SELECT round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem",
    "ml_assemble": """
        SELECT l_orderkey, l_linenumber, l_extendedprice AS label, l_quantity AS x_l_quantity,
               l_discount AS x_l_discount, l_tax AS x_l_tax
        FROM lineitem""",
    "zscore": """
        SELECT p_partkey,
               round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_samp(p_size) FROM part), 6) AS z_size,
               round((p_retailprice - (SELECT avg(p_retailprice) FROM part))
                     / (SELECT stddev_samp(p_retailprice) FROM part), 6) AS z_price
        FROM part""",
    "ml_scale": """
        SELECT l_orderkey, l_linenumber,
               round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 6) AS z_l_quantity,
               round((l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER (), 6) AS z_l_discount,
               round((l_tax - avg(l_tax) OVER ()) / stddev_samp(l_tax) OVER (), 6) AS z_l_tax
        FROM lineitem""",
    "string_index": """
        SELECT event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS index
        FROM events GROUP BY event_type""",
    "index_to_string": """
        WITH idx AS (
          SELECT event_type,
                 CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS event_index
          FROM events GROUP BY event_type)
        SELECT e.event_id, i.event_index, i.event_type AS event_type_back
        FROM events e JOIN idx i ON e.event_type = i.event_type""",
    "ml_tokenize": f"""
        WITH t AS (SELECT doc_id, {_TOKENS} AS toks FROM documents)
        SELECT doc_id, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS token FROM t""",
    "ml_tfidf": f"""
        WITH t AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents),
             tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
             idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf
                     FROM tf GROUP BY term)
        SELECT tf.doc_id, tf.term, tf.tf, round(idf.idf, 6) AS idf, round(tf.tf * idf.idf, 6) AS tfidf
        FROM tf JOIN idf ON tf.term = idf.term""",
    "ml_linreg": """
        SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
               round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept
        FROM lineitem""",
    "eval_accuracy": """
        SELECT round(avg(CASE WHEN quality = CASE WHEN toxic = 0 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END), 6)
               AS accuracy
        FROM labels""",
    "eval_r2": """
        WITH m AS (SELECT l_returnflag, avg(l_quantity) AS p FROM lineitem GROUP BY l_returnflag)
        SELECT round(1 - sum((l.l_quantity - m.p) ^ 2)
                         / sum((l.l_quantity - (SELECT avg(l_quantity) FROM lineitem)) ^ 2), 6) AS r2
        FROM lineitem l JOIN m ON l.l_returnflag = m.l_returnflag""",
}
