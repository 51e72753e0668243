"""Models and labels as tables: indexing without the driver, trees as SQL, ALS factors, hashed terms, layout."""

import random
import re

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from quarry.ml import factors as fa
from quarry.ml import features as fe
from quarry.ml import models as mo
from quarry.ml import rules as ru
from quarry.operators import layout
from quarry.plans import model_catalog
from tests.compare import compare
from tests.conftest import SF_SMALL


def test_label_ranks_order_and_back(spark):
    rows = [(i, v) for i, v in enumerate(["b", "a", "b", None, "c", "a", "é", "", "d"])]
    df = spark.createDataFrame(rows, "id int, s string").repartition(4)
    labels = fe.label_ranks(df, "s")
    assert [(r.label, r["index"]) for r in labels.orderBy("index").collect()] == [("a", 0.0), ("b", 1.0), ("", 2.0), ("c", 3.0), ("d", 4.0), ("é", 5.0)]
    more = df.unionByName(spark.createDataFrame([(99, "new")], df.schema))
    kept = {r.id: r.i for r in fe.index_labels(more, "s", "i", labels).collect()}
    assert kept[0] == 1.0 and kept[99] == 6.0 and kept[3] == 6.0  # unseen and null: the number of labels
    assert fe.index_labels(more, "s", "i", labels, "skip").count() == 8
    with pytest.raises(Exception, match="unseen value"):
        fe.index_labels(more, "s", "i", labels, "error").collect()
    with pytest.raises(ValueError):
        fe.index_labels(more, "s", "i", labels, "other")
    back = fe.labels_back(fe.index_labels(more, "s", "i", labels), "i", "t", labels)
    assert all(r.t == (r.s if r.s != "new" else None) for r in back.collect())
    assert fe.label_ranks(df.limit(0), "s").count() == 0


def test_same_indexes_as_the_fitted_indexer(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(f"v{rng.randrange(40)}",) for _ in range(500)], "s string").repartition(3)
    _, model = fe.string_index(df, "s", "i")
    assert [r.label for r in fe.label_ranks(df, "s").orderBy("index").collect()] == list(model.labels)


def test_a_million_labels(spark):
    n = 1_000_000
    df = spark.range(n + 5).select(F.concat(F.lit("k"), F.least("id", F.lit(n - 1)).cast("string")).alias("s"))
    labels = fe.label_ranks(df, "s")
    got = labels.agg(F.count(F.lit(1)), F.countDistinct("index"), F.min("index"), F.max("index"), F.sum(F.col("index").cast("bigint"))).first()
    assert tuple(got) == (n, n, 0.0, n - 1.0, n * (n - 1) // 2)
    assert labels.where("index = 0").first().label == f"k{n - 1}"  # six rows
    assert [r.label for r in labels.where("index in (1, 2)").orderBy("index").collect()] == ["k0", "k1"]


def _points(spark, n=600):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        x = [rng.uniform(-1, 1) for _ in range(5)]
        rows.append((i, x, float((x[0] > 0.2) + (x[3] > 0) * (x[1] < 0.5))))
    return fe.array_features(spark.createDataFrame(rows, "id int, x array<double>, label double"), "x")


def test_tree_as_sql_in_another_engine(spark):
    df = _points(spark)
    model = mo.decision_tree(df, max_depth=4)
    nodes = ru.node_table(spark, model)
    assert nodes.count() == model.numNodes and nodes.where("not is_leaf").count() == model.numNodes // 2
    own = {r.id: r.prediction for r in model.transform(df).select("id", "prediction").collect()}
    points = df.select("id", "x").toPandas()  # noqa: F841
    got = duckdb.sql(f"SELECT id, {ru.tree_sql(nodes, 'x[{1}]')} AS p FROM points").fetchall()
    assert dict(got) == own and len(set(own.values())) == 3
    walked = ru.tree_walk(df.select("id", "x"), nodes, "x", model.depth, ["id"])
    assert {r.id: r.prediction for r in walked.collect()} == own


def test_forest_as_sql_in_another_engine(spark):
    df = _points(spark)
    model = mo.random_forest(df, num_trees=7, max_depth=4)
    nodes = ru.node_table(spark, model)
    assert nodes.select("tree").distinct().count() == 7
    votes, pick = ru.forest_sql(nodes, "x[{1}]")
    points = df.select("id", "x").toPandas()  # noqa: F841
    got = duckdb.sql(f"SELECT id, {pick} AS p FROM (SELECT id, {', '.join(f'{v} AS v{k}' for k, v in enumerate(votes))} FROM points)").fetchall()
    assert dict(got) == {r.id: r.prediction for r in model.transform(df).select("id", "prediction").collect()}


def test_one_leaf(spark):
    df = fe.array_features(spark.createDataFrame([(1, [1.0], 0.0), (2, [2.0], 0.0)], "id int, x array<double>, label double"), "x")
    nodes = ru.node_table(spark, mo.decision_tree(df))
    assert nodes.count() == 1 and df.select(F.expr(ru.tree_sql(nodes)).alias("p")).distinct().collect()[0].p == 0.0


def test_factors_give_the_models_predictions(spark):
    rng = random.Random(2)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(30), rng.randrange(25), rng.uniform(1, 5)) for _ in range(500)]  # one hot user
    train = spark.createDataFrame(rows, "u int, i int, r float").dropDuplicates(["u", "i"])
    model = mo.als(train, "u", "i", "r", rank=4, max_iter=3, blocks=2)
    users, items = fa.factor_tables(model)
    pairs = train.unionByName(spark.createDataFrame([(500, 1, 3.0), (1, 900, 3.0), (None, 2, 1.0)], train.schema))
    got = fa.score_pairs(pairs, users, items, "u", "i")
    own = {(r.u, r.i): r.prediction for r in model.transform(train).collect()}
    for r in got.collect():
        assert r.known == ((r.u, r.i) in own)
        assert r.prediction == pytest.approx(own[r.u, r.i], rel=1e-5) if r.known else r.prediction != r.prediction
    e = fa.rating_error(got, "r").first()
    want = sum((r.r - own[r.u, r.i]) ** 2 for r in train.collect()) / train.count()
    assert (e.known_pairs, e.cold_pairs) == (train.count(), 3) and e.rmse == pytest.approx(want ** 0.5, rel=1e-4)


def _item_shuffles(df, item):
    return len(re.findall(rf"Exchange hashpartitioning\({item}#", df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, was)


def test_model_between_the_joins(spark, no_broadcast):
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(30), 1 if rng.random() < 0.4 else rng.randrange(25), rng.uniform(1, 5)) for _ in range(500)]
    train = spark.createDataFrame(rows, "u int, i int, r float").dropDuplicates(["u", "i"])
    model = mo.als(train, "u", "i", "r", rank=4, max_iter=3, blocks=2)
    users, items = fa.factor_tables(model)
    pairs = train.unionByName(spark.createDataFrame([(500, 1, 3.0), (1, 900, 3.0), (700, 800, 1.0), (1, 900, 3.0)], train.schema))

    def own(df):
        return model.transform(df).withColumnRenamed("prediction", "own")

    apart, shared = fa.score_pairs(own(pairs), users, items, "u", "i"), fa.score_pairs(pairs, users, items, "u", "i", between=own)
    assert (_item_shuffles(apart, "i"), _item_shuffles(shared, "i")) == (2, 1)
    assert shared.columns == apart.columns == ["u", "i", "r", "own", "known", "prediction"]
    assert sorted(map(str, shared.collect())) == sorted(map(str, apart.collect()))


def test_als_scores_deal_the_pairs_by_item_once(spark, no_broadcast):
    assert _item_shuffles(queries()["ml_als_scores"](spark, SF_SMALL), "item_id") == 1


def test_ratings_are_numbered_without_being_written_for_it(spark, tmp_out, monkeypatch):
    lines = [(1, 10, 2.0), (1, 10, 4.0), (2, 10, 5.0), (2, 1 << 40, 7.0), (3, None, 1.0), (None, 11, 1.0), (4, 12, 1.0), (9, 13, 1.0), (5, 11, 3.0)]
    orders = [(1, 100), (2, 100), (3, 100), (4, None), (5, 1 << 41), (5, 1 << 41), (6, 102), (None, 103)]  # 6 has no lines, 9 no order
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_out}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_out}/orders.parquet")
    labels, written = [], layout.written
    monkeypatch.setattr(layout, "written", lambda df, label: labels.append(label) or written(df, label))
    got = model_catalog._ratings(spark, tmp_out).collect()
    assert labels == ["ratings-numbered"]
    assert sorted((r.user, r.item, r.rating) for r in got) == [(100, 10, 11 / 3), (100, 1 << 40, 7.0), (1 << 41, 11, 3.0)]
    for key, number in (("user", "user_id"), ("item", "item_id")):
        assert len({r[key] for r in got}) == len({r[number] for r in got}) == len({(r[key], r[number]) for r in got})
        assert all(0 <= r[number] < 6 for r in got)


def test_hashed_terms_collide_and_add_up(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "c"]), (2, ["b"]), (3, [])], "doc int, t array<string>")
    one = fe.bucket_frequencies(df, "doc", "t", 1).orderBy("doc").collect()  # all terms in one bucket
    assert [tuple(r) for r in one] == [(1, 0, 4, 3), (2, 0, 1, 1)]
    wide = {r.doc: r for r in fe.sparse_rows(fe.bucket_frequencies(df, "doc", "t", 1 << 18), "doc", 1 << 18).collect()}
    assert sorted(wide[1]["values"]) == [1, 1, 2] and wide[1].indices == sorted(wide[1].indices) and set(wide[2].indices) <= set(wide[1].indices)


def _tasks_of(df):
    """Tasks that count: of the plan's exchange by document, or the files of counts they wrote."""
    dealt = re.findall(r"hashpartitioning\(doc_id#\d+L?, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())
    return max([len(df.inputFiles()), *map(int, dealt)])


def _long_texts():
    return [(i, " ".join(f"w{(i * 31 + k) % 97}" for k in range(300))) for i in range(200)] + [(7, "w1 extra"), (None, "a b a"), (500, None), (501, "")]


def test_tasks_grow_with_the_text(spark, monkeypatch):
    df = spark.createDataFrame(_long_texts(), "doc_id long, text string")
    size = sum(len(t or "") for _, t in _long_texts())
    cores = spark.sparkContext.defaultParallelism
    assert fe.text_tasks(df, "text") == cores and fe.text_tasks(df.where("false"), "text") == cores
    assert fe.text_tasks(df, "text", 1000) == -(-size // 1000) > 100 > cores
    monkeypatch.setattr(fe, "TASK_BYTES", 1000)
    dealt = fe.by_document(df, "doc_id", "text").select("doc_id", F.spark_partition_id().alias("p")).collect()
    assert len(dealt) == 204 and len({r.p for r in dealt}) > 80 and len({r.p for r in dealt if r.doc_id == 7}) == 1


@pytest.mark.parametrize("key", ["ml_nb_terms", "ml_tfidf_split", "ml_tfidf", "ml_hashed_tf", "ml_hashed_vectors"])
def test_documents_are_dealt_by_their_size(spark, tmp_out, monkeypatch, key):
    monkeypatch.setattr(fe, "TASK_BYTES", 1000)
    con = duckdb.connect()
    for name, rows, schema in (("documents", _long_texts(), "doc_id long, text string"), ("labels", [(i, i % 2) for i in range(0, 200)], "doc_id long, quality int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_out}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_out}/{name}.parquet/*.parquet')")
    df = queries()[key](spark, tmp_out)
    assert _tasks_of(df) > 60
    assert compare(df, con, oracle_sql()[key]) is None


def test_sized_files_and_profile(spark, tmp_out):
    df = spark.range(5000).select("id", (F.col("id") % 4 == 0).cast("int").alias("k"), F.md5(F.col("id").cast("string")).alias("t"))
    df.write.parquet(f"{tmp_out}/a")
    size = layout.row_bytes(spark.read.parquet(f"{tmp_out}/a")).first()
    assert size.rows == 5000 and size.bytes_per_row == pytest.approx(size.bytes / 5000)
    most = layout.write_sized(df, f"{tmp_out}/b", 20_000, size.bytes_per_row, ("k",))
    p = {r.k: r for r in layout.file_profile(spark.read.parquet(f"{tmp_out}/b"), "k").collect()}
    assert (p[1].rows, p[0].rows) == (1250, 3750) and max(p[0].most_rows, p[1].most_rows) <= most < 5000
    whole = layout.file_profile(spark.read.parquet(f"{tmp_out}/b")).first()
    assert whole.files == p[0].files + p[1].files and whole.rows == 5000


def test_vectors_keep_plain_columns(spark):
    df = _points(spark, 10)
    assert df.select(vector_to_array("features")[0]).count() == 10
