import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql.functions import spark_partition_id

from quarry.llm import lattice_lm as lm
from quarry.llm.pieces import vocabulary
from quarry.llm.queries import QUERIES, VOCABULARY
from tests.conftest import SF_CHECK

from . import awkward


@pytest.fixture(scope="module")
def lat():
    return lm.lattice(VOCABULARY)


@pytest.fixture(scope="module")
def weights(lat):
    return lat.score_weights(lat.depth(vocabulary(VOCABULARY)))


def segmentations(lat, text):
    """All ways to cut a text into pieces (a character that is no piece: its bytes)."""
    if not text:
        yield []
    for k in range(1, len(text) + 1):
        head = text[:k]
        ids = [lat.normal[head]] if head in lat.normal else lat.char_bytes(ord(head)) if k == 1 else None
        if ids:
            for rest in segmentations(lat, text[k:]):
                yield ids + rest


WORDS = ["", "a", "the", "thered", "éß", "日本", "x\x00y", "▁", "there,", "wörter", "😀b", "aaaaaa"]


def test_marginal_is_the_sum_over_all_segmentations(lat, weights):
    for w, got in zip(WORDS, lat.log_probability(WORDS, weights)):
        ways = list(segmentations(lat, "▁" + w))
        assert got == pytest.approx(math.log(sum(math.exp(weights[s].sum()) for s in ways)), rel=1e-9), w


def test_expected_uses(lat, weights):
    counts = np.arange(1.0, len(WORDS) + 1)
    want = np.zeros(lat.size + 1)
    for w, c in zip(WORDS, counts):
        ways = list(segmentations(lat, "▁" + w))
        p = np.array([math.exp(weights[s].sum()) for s in ways])
        for s, q in zip(ways, p / p.sum()):
            np.add.at(want, s, c * q)
    assert np.allclose(lat.expected(WORDS, counts, weights) * lm.UNIT, want, atol=1e-4)


def test_long_words_take_the_same_recursion(lat, weights, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeinorst日é") for _ in range(n)) for n in (1, 5, 20, 38)]
    fast, uses = lat.log_probability(words, weights), lat.expected(words, np.ones(4), weights)
    monkeypatch.setattr(lm, "LONG_WORD", 0)
    assert np.allclose(fast, lat.log_probability(words, weights)) and np.allclose(uses, lat.expected(words, np.ones(4), weights), atol=100)
    assert np.isfinite(lat.log_probability(["x" * 5000], weights)).all()


def brute(rows):
    words = {k: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for k, (_, t) in enumerate(rows)}
    out_of = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter()
    for k, (i, _) in enumerate(rows):
        if not out_of(i):
            c.update([*words[k], "</end>"])
    total = sum(c.values())
    return sorted((str(i), out_of(i), len(words[k]) + 1, sum(w in c for w in [*words[k], "</end>"]), total,
                   round(sum(math.log10((c[w] + 1) / (total + len(c) + 1)) for w in [*words[k], "</end>"]), 5)) for k, (i, _) in enumerate(rows))


def shown(rows):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)


def test_awkward_rows(spark):
    rows = lm.lm_scores(awkward.frame(spark), VOCABULARY).collect()
    assert shown(rows) == brute([(r[0], r[1]) for r in awkward.rows()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert lm.lm_scores(awkward.empty(spark), VOCABULARY).count() == 0


def test_blocks_do_not_change_scores(spark):
    key = lambda df: sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in df.collect())
    assert key(lm.lm_scores(awkward.frame(spark), VOCABULARY)) == key(lm.lm_scores(awkward.frame(spark).repartition(7), VOCABULARY, block_bytes=60))


def test_query(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op9_lattice_lm"](spark, SF_CHECK).collect()
    assert shown(rows) == brute([(r.doc_id, r.text) for r in docs])
    out = [r for r in rows if r.held_out]
    # unseen words cost the word model dearly; pieces know them
    assert sum(r.score for r in out) / sum(r.n_tokens for r in out) > -8


def test_the_power_of_the_scores_is_found_again(lat):
    depth = lat.depth(vocabulary(VOCABULARY))
    for power in (0.3, 1.0, 1.7):
        assert lm.fitted_power(1e6 * np.exp(lat.score_weights(depth, power)), depth) == pytest.approx(power, abs=1e-6)


def plain_score(rows):
    """The whole model once more, word by word in plain loops: log10 probability of each row's text."""
    voc = vocabulary(VOCABULARY)
    last = max(voc.rank.values()) + 1
    prob = lambda power: [(voc.rank.get(i, last) + 2) ** -power for i in range(voc.size + 1)]
    longest = max(map(len, voc.normal))

    def ways(text):
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - longest), end):
                if text[start:end] in voc.normal:
                    yield start, end, [voc.normal[text[start:end]]]
                elif end - start == 1:
                    yield start, end, [voc.byte_id[b] for b in text[start:end].encode("utf-8", "surrogatepass")]

    def both(text, p):
        a, b, every = [1.0] + [0.0] * len(text), [0.0] * len(text) + [1.0], [(s, e, ids, math.prod(p[i] for i in ids)) for s, e, ids in ways(text)]
        for s, e, _, w in every:
            a[e] += a[s] * w
        for s, e, _, w in sorted(every, key=lambda x: -x[1]):
            b[s] += w * b[e]
        return a, b, every

    tokens = {k: [w.decode("utf-8", "surrogatepass") for w in lm.words_of(t or "")] for k, (_, t) in enumerate(rows)}
    train = [k for k, (i, _) in enumerate(rows) if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    counts = Counter(w for k in train for w in tokens[k])
    norm = lambda x: [v / sum(x) for v in x]
    p, uses = norm(prob(1.0)), [0.0] * (voc.size + 1)
    uses[-1] = float(len(train))
    for w, c in counts.items():
        a, b, every = both("▁" + w, p)
        for s, e, ids, weight in every:
            for i in ids:
                uses[i] += c * a[s] * weight * b[e] / a[-1]
    # the likeliest power on a fine grid
    depth = [math.log(voc.rank.get(i, last) + 2) for i in range(voc.size + 1)]
    fit = lambda power: -power * sum(u * d for u, d in zip(uses, depth)) - sum(uses) * math.log(sum(prob(power)))
    power = max((k / 10 for k in range(1, 40)), key=fit)
    for step in (0.01, 0.001, 0.0001):
        power = max((power + k * step for k in range(-10, 11)), key=fit)
    p = [lm.SCORE_SHARE * x + (1 - lm.SCORE_SHARE) * y for x, y in zip(norm(prob(power)), norm(uses))]
    value = {w: math.log10(both("▁" + w, p)[0][-1]) for w in {w for some in tokens.values() for w in some}}
    return [sum(value[w] for w in tokens[k]) + math.log10(p[-1]) for k in tokens]


def test_scores_of_a_table_equal_the_plain_model(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").orderBy("doc_id").select("doc_id", "text").take(40)]
    rows += [(10**6, "naïve Ω😀 x\x00y"), (10**6 + 1, None)]
    got = {r.doc_id: r.score for r in lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), VOCABULARY, block_bytes=20_000).collect()}
    assert len(got) == len(rows)
    for (i, _), want in zip(rows, plain_score(rows)):
        assert got[i] == pytest.approx(want, rel=1e-4), i


def test_without_training_rows_the_scores_of_the_file_weight_the_pieces(spark, lat, weights):
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    for r in lm.lm_scores(spark.createDataFrame([(i, "the end") for i in out], "doc_id long, text string"), VOCABULARY).collect():
        assert r.held_out and r.n_known == 0 and r.train_tokens == 0
        assert r.score == pytest.approx((lat.log_probability(["the", "end"], weights).sum() + weights[-1]) / math.log(10))


def test_every_block_has_a_task_of_its_own(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "repeat('a word ', cast(id % 40 as int)) as text").repartition(5)
    blocked, blocks = lm.numbered(lm.in_blocks(docs, "doc_id", "text", 7, 2, 2_000).persist())
    rows = blocked.collect()
    assert len(rows) == 300 and blocks > 20 and {r.block for r in rows} == set(range(blocks))
    per_task = blocked.repartitionById(blocks, "block").withColumn("task", spark_partition_id()).select("block", "task").distinct().collect()
    assert len(per_task) == blocks == len({r.task for r in per_task})


def test_scores_meet_their_texts_by_one_exchange_a_side(spark):
    plan = lm.lm_scores(awkward.frame(spark), VOCABULARY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("direct_shuffle_partition_id") == 2 and "hashpartitioning(block" not in plan
