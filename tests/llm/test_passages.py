import random
from collections import defaultdict

import pytest

from quarry.llm import passages as ps
from tests.conftest import SF_CHECK

from . import awkward


def brute(rows):
    """Words of each text that lie in a 50-word window found in another text; whole copies count as a whole."""
    texts = defaultdict(list)
    for i, t in rows:
        texts[t or ""].append(i)
    words = {t: ps.split_words(t) for t in texts}
    where = defaultdict(set)
    for t, w in words.items():
        for k in range(len(w) - ps.MIN_WORDS + 1):
            where[tuple(w[k:k + ps.MIN_WORDS])].add(t)
    out = defaultdict(set)
    for t, w in words.items():
        if len(texts[t]) > 1 and len(w) >= ps.MIN_WORDS:
            spans = {(0, len(w))}
        else:
            hit = [k for k in range(len(w) - ps.MIN_WORDS + 1) if len(where[tuple(w[k:k + ps.MIN_WORDS])]) > 1]
            spans, at = set(), None
            for k in hit:
                if at is not None and k <= at[1]:
                    at[1] = k + ps.MIN_WORDS
                else:
                    spans.add(tuple(at)) if at else None
                    at = [k, k + ps.MIN_WORDS]
            spans.add(tuple(at)) if at else None
        for i in texts[t]:
            out[i] |= spans
    return {i: s for i, s in out.items() if s}


def found(df):
    out = defaultdict(set)
    for r in df.collect():
        out[r.doc_id].add((r.first_word, r.end_word))
        assert r.n_words == r.end_word - r.first_word >= ps.MIN_WORDS
    return dict(out)


def planted(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 9)))
    pool = [[word() for _ in range(k)] for k in (49, 50, 51, 57, 80, 200)]
    rows = []
    for i in range(n):
        text = [word() for _ in range(rng.randrange(0, 150))]
        for p in rng.sample(pool, rng.randrange(0, 3)):
            text += p + [word() for _ in range(rng.randrange(0, 40))]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages_exact(spark, seed):
    rows = planted(seed)
    rows += [(500, rows[3][1]), (501, rows[4][1] + " more"), (502, "x" + rows[4][1])]
    got = ps.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert found(got) == brute(rows)
    text = dict(rows)
    assert all(r.other_id != r.doc_id and text[r.other_id] for r in got.collect())


def test_hot_passage_across_many_tasks(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("hijklmn") for _ in range(5))
    hot = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(30)] + (hot if i % 3 == 0 else []) + [word() for _ in range(30)])) for i in range(900)]
    assert found(ps.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def crowded(seed, n=160):
    """One seed in most texts, its right and left contexts mixed freely: partners stand far apart in the order."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("opqrst") for _ in range(6))
    core = [word() for _ in range(14)]
    right = [[word() for _ in range(40)] for _ in range(6)]
    left = [[word() for _ in range(40)] for _ in range(6)]
    rows = []
    for i in range(n):
        a, b = rng.randrange(0, 41), rng.randrange(0, 41)
        text = [word() for _ in range(20)] + rng.choice(left)[40 - a:] + core + rng.choice(right)[:b] + [word() for _ in range(20)]
        rows.append((i, " ".join(text * rng.choice((1, 1, 1, 2)))))
    return rows


@pytest.mark.parametrize("run, tasks", [(20_000, 1), (7, 1), (20_000, 5), (3, 8)])
def test_crowded_seed_is_exact(spark, monkeypatch, run, tasks):
    monkeypatch.setattr(ps, "RUN", run)
    rows = crowded(run + tasks)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        assert found(ps.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_windows_of_parts_meet_by_hash():
    rows = [[r.split(" ")[30:80], r.split(" ")[:30][::-1], k, 30, k] for k, r in crowded(3, 60)]
    matches, outside = ps._same_windows(rows, ps.np.ones(len(rows), dtype=bool))
    alone = [ps._same_windows([r], ps.np.ones(1, dtype=bool)) for r in rows]
    assert not any(m for m, _ in alone) and {o[4] for _, out in alone for o in out} == {o[4] for o in outside}


def test_windows_of_one_first_hash_are_told_apart_by_the_second(monkeypatch):
    words = lambda k, n: [f"w{k}_{i}" for i in range(n)]
    rows = [[words("seed", ps.SEED) + words(k, 37) + ["end"], [], k, 0, k] for k in (1, 2)]
    monkeypatch.setattr(ps, "_BASE", ps.np.uint64(0))  # the first half is the hash of a window's last word
    low, high, there = ps._windows(rows)
    assert low[there].tolist() == [low[there][0]] * 2 and len(set(high[there].tolist())) == 2
    matches, outside = ps._same_windows(rows, ps.np.ones(2, dtype=bool))
    assert matches == [] and len(outside) == 2


def test_repeats_inside_one_text_do_not_count(spark):
    one = " ".join(f"w{i}" for i in range(70))
    rows = [(1, one + " mid " + one), (2, "other words " * 60)]
    assert ps.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def test_awkward_rows(spark):
    got = ps.repeated_passages(awkward.frame(spark)).collect()
    assert {(r.doc_id, r.n_words, r.other_id) for r in got} == {(6, 60_000, 7), (7, 60_000, 6)}
    assert ps.repeated_passages(awkward.empty(spark)).count() == 0


def test_query(spark):
    from quarry.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    want, got = brute([(r.doc_id, r.text) for r in docs]), found(QUERIES["op4_sparse_suffixes"](spark, SF_CHECK))
    assert got == want


def test_texts_with_one_key_stay_apart(spark, monkeypatch):
    """A first key of few values: texts that share it are told apart by the second one."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(ps, "_text_key", lambda text: F.pmod(F.xxhash64(text), F.lit(40)))
    rows = planted(21, n=150)
    rows += [(1000 + i, t) for i, t in rows[:30]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(ps.repeated_passages(df)) == brute(rows)
