import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from quarry.llm import simhash as sh
from tests.conftest import SF_CHECK

from . import awkward


def brute_fp(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass"), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, max_bits=3):
    fps = sorted({f for _, f in rows})
    arr, up = np.array(fps, dtype=np.uint64), list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= max_bits):
            a, b = find(i), find(i + 1 + int(j))
            up[max(a, b)] = min(a, b)
    least = defaultdict(lambda: None)
    at = {f: find(i) for i, f in enumerate(fps)}
    for d, f in rows:
        if d is not None and (least[at[f]] is None or d < least[at[f]]):
            least[at[f]] = d
    return sorted(((d, f"{f:016x}", least[at[f]]) for d, f in rows), key=str)


def test_awkward_rows(spark):
    got = sh.simhash_groups(awkward.frame(spark)).select("doc_id", "fingerprint", "component_id")
    want = brute_components([(r[0], brute_fp(r[1])) for r in awkward.rows()])
    assert sorted(map(tuple, got.collect()), key=str) == want
    kept = sh.keep_one(awkward.frame(spark))
    assert kept.columns == awkward.frame(spark).columns
    texts = {r[1] or "" for r in awkward.rows()}
    groups = brute_components([(i, brute_fp(t)) for i, t in enumerate(sorted(texts))])
    assert kept.count() == len({g[2] for g in groups})  # one row of each group, repeats and rows without ids too
    assert sh.simhash_groups(awkward.empty(spark)).count() == 0 and sh.keep_one(awkward.empty(spark)).count() == 0


def test_one_row_of_each_group(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "x"), (1, text, "w"), (2, text, "a"), (None, text, "0"), (None, "alone without any id", "z"), (None, "alone without any id", "y"), (3, "else where we stand", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string")
    want = [(1, text, "w"), (3, "else where we stand", None), (None, "alone without any id", "y")]
    for parts in (1, 4):
        assert sorted(map(tuple, sh.keep_one(df.repartition(parts)).collect()), key=str) == want


@pytest.mark.parametrize("seed,bits", [(1, 3), (2, 3), (3, 1), (4, 0)])
def test_index_finds_every_pair(seed, bits):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(30)]
    near = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2 ** 64 - 1) for b in base for _ in range(30)}
    rank = lambda x: (lambda f: f(f, x, 1))(lambda f, y, k: y if k > 32 else f(f, y ^ (y >> k), 2 * k))
    fps = np.array(sorted(near, key=rank), dtype=np.uint64)
    index = sh.GrayIndex(fps)
    got = set(zip(*(x.tolist() for x in index.search(0, len(fps), bits))))
    want = {(i, i + 1 + int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= bits)}
    assert got == want and (want or not bits)


def test_links_across_keys_and_chains(spark):
    """Planted chains of fingerprints 3 bits apart, in shuffled order, beside a dense ball."""
    rng = random.Random(9)
    rows = []
    for c in range(20):
        f = rng.getrandbits(64)
        for step in range(12):
            rows.append((1000 * c + (step * 7) % 12, f))
            for b in rng.sample(range(64), 3):
                f ^= 1 << b
    ball = rng.getrandbits(64)
    rows += [(50_000 + i, ball ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))) for i in range(600)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(d, 0, f - 2 ** 64 if f >> 63 else f) for d, f in rows], "doc_id long, row_key long, fp long")
    got = sh.groups_of(df).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows)


def test_query_on_whole_table(spark):
    from quarry.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    want = brute_components([(r.doc_id, brute_fp(r.text)) for r in docs])
    got = QUERIES["op7_simhash_groups"](spark, SF_CHECK).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert len({w[2] for w in want}) < len(want)
