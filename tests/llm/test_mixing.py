from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing
from tests.compare import compare, duck
from tests.conftest import SF_CHECK

from . import awkward


def water(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Targets by resharing the excess until none is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > cap * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 3}, {"a": 0, "b": 0}, {"x": 7}, {f"s{i:02}": (i * 37) % 101 for i in range(40)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = water(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_awkward_rows(spark):
    out = mixing.mix(awkward.frame(spark)).collect()
    assert len(out) == len(awkward.rows())
    assert all(0 <= r["copies"] <= 2 for r in out)
    assert {r["size"] for r in out if r.doc_id in (3, 4, 5)} == {0}
    again = mixing.mix(awkward.frame(spark).repartition(5)).collect()
    key = lambda rows: sorted((str(r.doc_id), r["size"], r["copies"]) for r in rows)
    assert key(out) == key(again)
    assert mixing.mix(awkward.empty(spark)).count() == 0 and mixing.mixed(awkward.empty(spark)).columns == awkward.empty(spark).columns


def test_query_and_nearness(spark):
    from quarry.llm.queries import ORACLES, QUERIES
    df = QUERIES["op6_pareto_mix"](spark, SF_CHECK)
    assert compare(df, duck(SF_CHECK), ORACLES["op6_pareto_mix"]) is None
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "source")
    by = (df.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"),
                                                       F.sum("size").alias("total"), F.first("source_size").alias("source_size")).collect())
    assert all(abs(r.taken - r.target) <= r.most / 2 and r.total == r.source_size for r in by)
    taken = defaultdict(int)
    for r in mixing.mixed(spark.read.parquet(f"{SF_CHECK}/documents.parquet")).groupBy("doc_id").count().collect():
        taken[r.doc_id] = r["count"]
    assert all(r.taken == r["size"] * taken[r.doc_id] for r in df.collect())


def test_inclusion_frequency(spark):
    """Over many seeds every document of equal size is taken about as often."""
    docs = spark.createDataFrame([(i, "w " * 3, "s") for i in range(40)] + [(100 + i, "w", "t") for i in range(40)], "doc_id long, text string, source string")
    runs = 10
    hits = defaultdict(int)
    union = None
    for k in range(runs):
        d = mixing.mix(docs, seed=f":{k}").select("doc_id", "copies")
        union = d if union is None else union.unionAll(d)
        if k % 5 == 4:
            for r in union.groupBy("doc_id").agg(F.sum("copies").alias("n")).collect():
                hits[r.doc_id] += r.n
            union = None
    for i in range(40):
        assert abs(hits[i] / runs - sum(hits[j] for j in range(40)) / 40 / runs) < 0.5
