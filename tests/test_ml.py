"""ML on planted data with known answers."""

import math
import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quarry.ml import features as fe
from quarry.ml import models as mo
from quarry.operators import sets


@pytest.fixture(scope="module")
def blobs(spark):
    rnd = random.Random(11)
    centres = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (10.0, 10.0)]
    rows = [(i, float(k), cx + rnd.gauss(0, 0.3), cy + rnd.gauss(0, 0.3))
            for i in range(400) for k, (cx, cy) in [(i % 4, centres[i % 4])]]
    df = spark.createDataFrame(rows, "id int, label double, x double, y double")
    return fe.assemble(df, ["x", "y"])


def test_linear_regression_exact_line(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 2.0) for x in range(50)], "x double, y double")
    model = mo.linear_regression(fe.assemble(df, ["x"]), "features", "y")
    facts = mo.regression_facts(spark, model).first()
    assert abs(facts.coefficients[0] - 3.0) < 1e-9 and abs(facts.intercept - 2.0) < 1e-7
    assert abs(facts.r2 - 1.0) < 1e-12
    pred = model.transform(fe.assemble(df, ["x"]))
    assert abs(mo.r2(pred, "y", "prediction").first().r2 - 1.0) < 1e-12


def test_classifiers_separate_blobs(spark, blobs):
    train, test = sets.split_by_key(blobs, ["id"], 0.7, seed=1)
    tree = mo.decision_tree(train, max_depth=4, seed=1)
    # split candidates come from quantile bins, which sit inside the blobs
    assert mo.accuracy(tree.transform(test)).first().accuracy >= 0.9
    assert mo.tree_facts(spark, tree).first().depth <= 4
    forest = mo.random_forest(train, seed=1)
    assert mo.accuracy(forest.transform(test)).first().accuracy >= 0.9
    # naive Bayes needs features >= 0: shift the blobs
    shifted = blobs.drop("features").withColumn("x", F.col("x") + 5).withColumn("y", F.col("y") + 5)
    tr, te = sets.split_by_key(fe.assemble(shifted, ["x", "y"]), ["id"], 0.7, seed=1)
    acc = mo.compare_classifiers(tr, te, mo.default_classifiers(seed=1))
    got = {r.model: r.accuracy for r in acc.collect()}
    assert set(got) == {"decision_tree", "random_forest", "naive_bayes"} and got["decision_tree"] >= 0.9


def test_kmeans_finds_planted_groups(spark, blobs):
    model = mo.kmeans(blobs, k=4, seed=1)
    pred = model.transform(blobs)
    # every planted group lands in exactly one cluster, and clusters differ
    pairs = pred.select("label", "prediction").distinct().collect()
    assert len(pairs) == 4 and len({r.prediction for r in pairs}) == 4


def test_pca_on_a_line(spark):
    df = spark.createDataFrame([(Vectors.dense([t, 2 * t, 0.0]),) for t in range(10)], ["features"])
    _, model = fe.pca(df, "features", 1)
    pc = [abs(x) for x in model.pc.toArray()[:, 0]]
    assert abs(pc[0] - 1 / 5 ** 0.5) < 1e-9 and abs(pc[1] - 2 / 5 ** 0.5) < 1e-9 and pc[2] < 1e-9


def test_scale_vectors_uses_sample_sd(spark):
    df = fe.assemble(spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double"), ["x"])
    out, _ = fe.scale_vectors(df)
    vals = sorted(r.scaled[0] for r in out.collect())
    assert [round(v, 9) for v in vals] == [-1.0, 0.0, 1.0]


def test_string_index_ties_alphabetical_and_back(spark):
    df = spark.createDataFrame([(s,) for s in ["b", "a", "c", "a", "b", "c"]], "s string")
    indexed, model = fe.string_index(df, "s", "i")
    assert model.labels == ["a", "b", "c"]
    back = fe.index_to_string(indexed, "i", "s2", model.labels)
    assert back.where("s <> s2").count() == 0


def test_tokenize_matches_ml_tokenizer(spark):
    df = spark.createDataFrame([("Hello  World\t",), ("",), (" \n",), ("A\u000bB",)], "text string")
    mine = [r.tokens for r in fe.tokenize(df, "text").collect()]
    ref = [r.tokens for r in fe.tokenizer_stage("text").transform(df).collect()]
    assert mine == ref


def test_tfidf_long_fitted_on_training_part(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a"]), (3, ["c"])], "doc int, tokens array<string>")
    fit = docs.where("doc <= 2")
    out = {(r.doc, r.term): (r.tf, r.idf) for r in fe.tfidf_long(docs, "doc", "tokens", fit).collect()}
    import math
    assert out[(1, "a")] == (2, pytest.approx(math.log(3 / 3)))
    assert out[(1, "b")][1] == pytest.approx(math.log(3 / 2))
    assert out[(3, "c")][1] == pytest.approx(math.log(3))  # unseen while fitting: df = 0


def test_text_pipeline_separates_topics(spark):
    rnd = random.Random(2)
    good = ["fine", "clean", "useful", "clear"]
    bad = ["spam", "buy", "cheap", "click"]
    rows = [(i, " ".join(rnd.choice(good if i % 2 else bad) for _ in range(8)), float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string, label double")
    train, test = sets.split_by_key(df, ["id"], 0.7, seed=3)
    model = mo.fit_text_classifier(train, "text", "label")
    assert mo.accuracy(model.transform(test)).first().accuracy == 1.0


def test_text_classifier_equals_the_plain_pipeline(spark):
    rnd = random.Random(7)
    words = ["red", "green", "blue", "grey", "pink"]
    rows = [(" ".join(rnd.choice(words) for _ in range(6)), float(i % 2)) for i in range(80)] + [("", 1.0)]
    df = spark.createDataFrame(rows, "text string, label double")
    one, two = mo.fit_text_classifier(df), mo.text_classifier().fit(df)
    a, b = ([(r.text, r.label, r.prediction) for r in m.transform(df).collect()] for m in (one, two))
    assert sorted(a) == sorted(b)


def test_term_naive_bayes_by_hand(spark):
    docs = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 1.0)], "doc int, label double")
    tf = spark.createDataFrame([(1, "a", 2, 0.0), (2, "b", 1, 0.0), (3, "b", 3, 1.0)], "doc int, term string, tf int, label double")
    terms, priors = mo.term_naive_bayes(tf, docs, "label", [0.0, 1.0])
    got = {r.term: (r.lp_0, r.lp_1) for r in terms.collect()}
    assert got["a"] == (pytest.approx(math.log(3 / 5)), pytest.approx(math.log(1 / 5)))
    assert got["b"] == (pytest.approx(math.log(2 / 5)), pytest.approx(math.log(4 / 5)))
    assert tuple(priors.first()) == (pytest.approx(math.log(3 / 5)), pytest.approx(math.log(2 / 5)))
    new = spark.createDataFrame([(8,), (9,)], "doc int")
    new_tf = spark.createDataFrame([(8, "b", 2), (8, "zzz", 5)], "doc int, term string, tf int")
    s = {r.doc: (r.score_0, r.score_1) for r in mo.term_scores(new_tf, new, "doc", terms, priors, 2).collect()}
    assert s[8] == (pytest.approx(math.log(3 / 5 * 4 / 25)), pytest.approx(math.log(2 / 5 * 16 / 25)))
    assert s[9] == (pytest.approx(math.log(3 / 5)), pytest.approx(math.log(2 / 5)))  # no known term: the priors


def test_classifier_comparison_reads_the_test_part_once(spark, blobs):
    train, test = sets.split_by_key(blobs.where("label >= 0"), ["id"], 0.7, seed=1)
    two = {k: v for k, v in mo.default_classifiers(seed=1).items() if k != "naive_bayes"}
    out = mo.compare_classifiers(train, test, two)
    assert [r.model for r in out.collect()] == list(two) and not train.is_cached
    one_by_one = {k: mo.accuracy(e.fit(train).transform(test)).first().accuracy for k, e in two.items()}
    assert {r.model: r.accuracy for r in out.collect()} == one_by_one


def test_dense_ids_of_large_keys(spark):
    keys = [(1 << 40) + 7 * i for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys + keys[:50]] + [(None,)], "k long").repartition(7)
    ids = {r.k: r.id for r in fe.dense_ids(df, "k").collect()}
    assert set(ids) == set(keys) and sorted(ids.values()) == list(range(500))
    assert fe.dense_ids(df.where("k < 0"), "k").count() == 0
    rows = spark.createDataFrame([(k, 10 + j, float(1 + i % 3 + j)) for i, k in enumerate(keys[:20]) for j in range(5)], "k long, item int, rating double")
    model = mo.als(rows.join(fe.dense_ids(rows, "k", "user"), "k"), "user", "item", "rating", rank=2, max_iter=3)
    assert model.userFactors.count() == 20


def test_als_recovers_low_rank_ratings(spark):
    users, items = range(20), range(15)
    u = {i: 1 + (i % 3) for i in users}
    v = {j: 1 + (j % 4) for j in items}
    rows = [(i, j, float(u[i] * v[j])) for i in users for j in items]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    train, test = sets.split_by_key(df, ["user", "item"], 0.8, seed=4)
    model = mo.als(train, "user", "item", "rating", rank=3, max_iter=15, reg_param=0.01, seed=4)
    pred = model.transform(test)
    rmse = pred.agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0]
    assert rmse < 0.5
    cold = spark.createDataFrame([(999, 1, 1.0)], "user int, item int, rating double")
    kept = model.transform(cold).collect()  # a pair unknown to the model is kept and says so
    assert len(kept) == 1 and math.isnan(kept[0].prediction)
    dropping = mo.als(train, "user", "item", "rating", rank=3, max_iter=2, seed=4, cold_start="drop")
    assert dropping.transform(cold).count() == 0
