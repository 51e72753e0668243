import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from quarry.llm import runs
from quarry.plans.tables import table
from tests.conftest import SF_CHECK

from . import awkward


def brute_runs(w):
    """All runs by comparing the words with themselves, shifted by every period."""
    w, out = np.array(w), set()
    for q in range(1, len(w) // 4 + 1):
        same = np.r_[False, w[:-q] == w[q:], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e + q - s >= max(6, 4 * q) and not any((w[s:e + q - r] == w[s + r:e + q]).all() for r in range(1, q)):
                out.add((s, e + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if plant and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    found = brute_runs([number[x] for x in w])
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2])) if found else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_random_words_against_brute_force():
    rng = random.Random(11)
    for _ in range(400):
        docs = []
        for _ in range(rng.randrange(1, 5)):
            w = []
            for _ in range(rng.randrange(6)):
                base = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(1, 12))]
                w += (base * rng.randrange(1, 9))[:rng.randrange(1, 90)] + [rng.randrange(4) for _ in range(rng.randrange(5))]
            docs.append(w)
        bounds = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
        got = list(zip(*(x.tolist() for x in runs.runs_of(np.array([x for d in docs for x in d], np.int64), bounds))))
        assert got == [(s + b, e + b, q) for d, b in zip(docs, bounds.tolist()) for s, e, q in brute_runs(d)]


def test_nested_and_overlapping_periods():
    for w in ([0] * 500, [0, 1] * 300, ([0] * 8 + [1]) * 40, ([0, 1] * 4 + [2]) * 9 + [0, 1] * 4, list(range(50)) * 4, list(range(50)) * 4 + [7]):
        got = list(zip(*(x.tolist() for x in runs.runs_of(np.array(w, np.int64), np.array([0, len(w)])))))
        assert got == brute_runs(w)


def test_grammar_derives_the_text_and_looks_at_each_boundary_once():
    rng = random.Random(3)
    w = np.array([rng.randrange(5) for _ in range(300)] * 3 + [1] * 100, np.int64)
    g = runs.Grammar(w, np.array([0, len(w)]))
    rules = len(g.first)
    assert rules and (g.times >= 1).all() and g.times.max() > 1
    assert sorted(set(g.owner[g.owner >= 0].tolist())) == list(range(rules)) and (g.owner >= 0).sum() == rules
    which, start, end = g.derived(np.arange(rules), g.start[g.first], g.high[np.array([np.flatnonzero(g.owner == r)[0] for r in range(rules)])])
    for r, s, e in zip(which.tolist(), start.tolist(), end.tolist()):
        first = g.start[g.first[r]]
        assert (w[s:e] == w[first:first + e - s]).all()  # every derivation spells the same words


def test_awkward_rows(spark):
    df = awkward.frame(spark)
    for plant in (True, False):
        got = sorted(map(tuple, runs.periodic_runs(df, plant).select(*COLS).collect()), key=str)
        assert got == sorted((brute(r[0], r[1], plant) for r in awkward.rows()), key=str)
    assert runs.periodic_runs(awkward.empty(spark), True).count() == 0


def test_query(spark):
    from quarry.llm.queries import QUERIES
    got = sorted(map(tuple, QUERIES["op11_periodic_runs"](spark, SF_CHECK).select(*COLS).collect()))
    docs = table(spark, SF_CHECK, "documents").select("doc_id", "text").collect()
    long = {r.doc_id for r in docs if len(r.text or "") > 20_000}  # brute force is quadratic
    assert [r for r in got if r[0] not in long] == sorted(brute(r.doc_id, r.text) for r in docs if r.doc_id not in long)
    assert len(got) == len(docs) and len(long) < 10 and sum(r[1] > 0 for r in got) > 30
    for r in docs:
        if r.doc_id in long and len(r.text) < 40_000:
            assert brute(r.doc_id, r.text) in got
