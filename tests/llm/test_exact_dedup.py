import hashlib
import random
import re
from collections import defaultdict

from quarry.llm import exact_dedup as ed
from tests.compare import compare, duck
from tests.conftest import SF_CHECK

from . import awkward


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_awkward_rows(spark):
    df = awkward.frame(spark)
    got = ed.exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute([(r[0], r[1]) for r in awkward.rows()])
    kept = ed.keep_first(df)
    assert kept.columns == df.columns
    # one row of each group: the repeated row 8 once, the row without an id as it is the only one of its text
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-3, 1, 2, 3, 5, 6, 8, 9, 10, 11, 2 ** 62]
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["a row without an id"]
    assert ed.exact_dedup(awkward.empty(spark)).count() == 0 and ed.keep_first(awkward.empty(spark)).count() == 0


def test_one_row_of_each_group(spark):
    """Ids loaded twice, other columns that differ, groups without ids: one row each, the same one on every run."""
    rows = [(1, "a b", "x"), (1, "a  b", "w"), (1, "a b", "x"), (2, "a b", "a"), (None, "c", "z"), (None, "c", "y"), (None, "a b", "0"), (3, "d", None), (3, "e", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string")
    want = [(1, "a  b", "w"), (3, "d", None), (3, "e", "q"), (None, "c", "y")]
    for parts in (1, 4):
        assert sorted(map(tuple, ed.keep_first(df.repartition(parts)).collect()), key=str) == want


def test_recursive_spill_gives_the_same_classes():
    rng = random.Random(5)
    rows = []
    for _ in range(4000):
        k = rng.randrange(900)
        rows.append((k * 0x9E3779B97F4A7C15 % 2 ** 64, f"content {k}" * 9, f"sha{k}", rng.randrange(10 ** 6), 1))
    want = {}
    for h, c, d, i, n in rows:
        least, copies = want.get(c, (i, 0))
        want[c] = (min(least, i), copies + n)
    depths = []
    got = {e[1]: (e[3], e[4]) for e in ed.grace(iter(rows), 3000, spilled=depths)}
    assert got == want and max(depths) >= 4  # buckets were partitioned again


def test_equal_hashes_do_not_merge_different_contents():
    rows = [(7, f"text {k % 5}" * 50, "d", k, 1) for k in range(40)]
    got = {e[1]: (e[3], e[4]) for e in ed.grace(iter(rows), 500)}
    assert got == {f"text {k}" * 50: (k, 8) for k in range(5)}


def test_small_budget_flushes_locally(spark):
    df = awkward.frame(spark)
    a = sorted(map(tuple, ed.exact_dedup(df).collect()), key=str)
    assert a == sorted(map(tuple, ed.exact_dedup(df, budget=100).collect()), key=str)


def test_query(spark):
    from quarry.llm.queries import ORACLES, QUERIES
    assert compare(QUERIES["op2_exact_dedup"](spark, SF_CHECK), duck(SF_CHECK), ORACLES["op2_exact_dedup"]) is None
