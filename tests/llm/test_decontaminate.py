import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from quarry.llm import decontaminate as dc
from quarry.llm import words
from tests.compare import compare, duck
from tests.conftest import SF_CHECK

from . import awkward

ITEMS = "item_id long, text string, fp long, t1 string, size int"


def split(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = split(t)
        size = min(10, len(w))
        for p in range(len(w) - size + 1 if w else 0):
            wins.setdefault(tuple(w[p:p + size]), set()).add("" if i is None else str(i))
    sizes = {len(g) for g in wins}
    out = []
    for d, t in docs:
        w, hit, ids = split(t), set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                if (got := wins.get(tuple(w[p:p + size]))) is not None:
                    hit |= set(range(p, p + size))
                    ids |= got
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "t", 2) for i, t in items], ITEMS)


def test_awkward_rows(spark):
    df, docs = awkward.frame(spark), [(r[0], r[1]) for r in awkward.rows()]
    quick = "THE quick, brown-fox jumps over the lazy dog again"
    items = [(1, quick), (2, "one"), (2, None), (3, ""), (None, "ÄÖ ß 日本語"), (10, quick + " and again"), (4, " ".join(awkward.LONG.split()[500:530])),
             (5, "nul"), (6, "not there at all"), (7, "x" * 5000), (10, "one"), (8, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w99x9")]
    want = brute(docs, items)
    assert sorted(map(tuple, dc.contamination(df, items_frame(spark, items)).collect()), key=str) == want
    assert sum(r[-1] for r in want) >= 8
    # a filter of one cell lets nearly everything through: the joins alone give the same
    assert sorted(map(tuple, dc.contamination(df, items_frame(spark, items), filter_bits=64).collect()), key=str) == want
    assert dc.contamination(awkward.empty(spark), items_frame(spark, items)).count() == 0
    clean = dc.contamination(df, items_frame(spark, []))
    assert sorted(map(tuple, clean.collect()), key=str) == brute(docs, [])


def test_random_passages_and_short_items(spark):
    rng = random.Random(2)
    word = lambda k: "w" + str(rng.randrange(k))
    items = [(i, " ".join(word(40) for _ in range(rng.choice([1, 2, 4, 5, 6, 9, 10, 11, 25])))) for i in range(60)]
    items += [(100 + i, "shared " * 3 + " ".join(f"s{k}" for k in range(20))) for i in range(30)]  # a passage of many items
    docs = []
    for d in range(120):
        w = [word(40) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            piece = split(rng.choice(items)[1])
            at, lo = rng.randrange(len(w) + 1), rng.randrange(len(piece))
            w[at:at] = piece[lo:lo + rng.randrange(1, 30)]
        docs.append((d % 100, " ".join(w)))
    got = dc.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), items_frame(spark, items).repartition(2))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_every_shared_span_shares_a_fingerprint():
    rng = random.Random(6)
    for _ in range(60):
        span = [f"w{rng.randrange(6)}" for _ in range(10)]  # few words: ties among the grams
        texts = [" ".join([f"w{rng.randrange(6)}" for _ in range(rng.randrange(9))] + span + [f"w{rng.randrange(6)}" for _ in range(rng.randrange(9))]) for _ in range(2)]
        marks = []
        for t in texts:
            cut = words.cut(pa.array([t]), words.LOWER_OR_DIGIT, fold=True)
            (_, start, fp, w1, w2), = dc.windows_of(cut, [10])
            at = split(t)
            where = next(p for p in range(len(at) - 9) if at[p:p + 10] == span)
            marks.append((fp[where], w1[where], w2[where]))
            # winnowing: no more fingerprints than the smallest gram of each window
            assert len(start) == len(at) - 9 and len(np.unique(fp)) <= len(np.unique(w1))
        assert marks[0] == marks[1]


def test_spans(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    docs = [(1, f"before {passage} between it {passage} after"), (2, "clean"), (3, " ".join(f"p{i}" for i in range(2, 13)))]
    got = dc.shared_spans(spark.createDataFrame(docs, "doc_id long, text string"), items_frame(spark, [(1, passage)]))
    assert sorted(map(tuple, got.collect())) == [(1, 1, 14), (1, 17, 14), (3, 0, 11)]


def test_query(spark):
    from quarry.llm.queries import ORACLES, QUERIES
    got = QUERIES["op13_winnowing"](spark, SF_CHECK)
    assert compare(got, duck(SF_CHECK), ORACLES["op13_winnowing"]) is None
    assert got.where("contaminated").count() > 10
