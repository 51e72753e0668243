import hashlib
import random

import numpy as np
import pytest

from quarry.llm import codes
from tests.compare import compare, duck
from tests.conftest import SF_CHECK

SCHEMA = "vec_id long, embedding array<float>, label int, ids int, v string, error double"


def brute(rows):
    keep = [(i, v, lab) for i, v, lab in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    if not keep:
        return []
    x = {k: np.floor(np.array(v, np.float32).astype(float) * 256).astype(np.int64).reshape(16, -1) for k, (_, v, _) in enumerate(keep)}
    order = sorted(x, key=lambda k: (keep[k][0] is None, keep[k][0] or 0, x[k].ravel().tolist()))
    book = [[x[k][p].tolist() for k in order[:64]] for p in range(16)]

    def nearest(part, p):
        d = [sum((int(a) - b) ** 2 for a, b in zip(part, e)) for e in book[p]]
        return min(range(len(d)), key=lambda e: (d[e], e)), min(d)

    for _ in range(2):
        new = [[list(e) for e in b] for b in book]
        for p in range(16):
            got = {}
            for k in x:
                got.setdefault(nearest(x[k][p], p)[0], []).append(x[k][p])
            for e, parts in got.items():
                new[p][e] = [int(s) // len(parts) for s in np.sum(parts, axis=0)]
        book = new
    out = []
    for k in x:
        near = [nearest(x[k][p], p) for p in range(16)]
        out.append((keep[k][0], "".join(f"{e:02x}" for e, _ in near), sum(d for _, d in near), keep[k][2]))
    by = {}
    for _, _, e, lab in out:
        by[lab] = by.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in book for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by[lab], sha) for i, c, e, lab in out), key=str)


def awkward():
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(32)], i % 3 if i % 7 else None) for i in range(90)]
    rows += [(100 + i, [0.25] * 32, 1) for i in range(40)]  # one vector many times: ties everywhere
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, 1), (201, [nan] + [0.0] * 31, 1), (202, [inf] * 32, 2), (203, [None] + [1.0] * 31, 2), (204, [0.0] * 32, None), (205, [], 1)]
    rows += [(3, [0.5] * 32, 9), (3, [0.5] * 32, 9), (None, [-0.5] * 32, 9), (-7, [1e-9, -1e-9] * 16, 4)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "v", 0.1) for r in rows], SCHEMA)


def test_awkward_rows(spark):
    want = brute(awkward())
    for block in (7, 64, 4096):
        got = codes.vector_codes(frame(spark, awkward()).repartition(3), block=block)
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_few_empty_and_odd_tables(spark):
    few = [(5, [0.1] * 16, 1), (2, [0.2] * 16, 1), (9, [0.1] * 16, None)]
    assert sorted(map(tuple, codes.vector_codes(frame(spark, few)).collect()), key=str) == brute(few)
    assert codes.vector_codes(frame(spark, [])).count() == 0
    assert codes.vector_codes(frame(spark, [(1, None, 1)])).count() == 0
    other = few + [(1000, [0.1] * 32, 1), (1001, [3e7] * 16, 1)]  # other length; beyond exact sums
    assert sorted(map(tuple, codes.vector_codes(frame(spark, other)).collect()), key=str) == brute(few)
    with pytest.raises(ValueError):
        codes.vector_codes(frame(spark, [(1, [0.1] * 17, 1)]))


def test_tree_invariants_and_pruned_assignment():
    rng = np.random.default_rng(8)
    for n, d, wide in ((1, 4, 9), (700, 4, 60), (3000, 2, 400), (500, 4, 2)):
        x = rng.integers(-wide, wide + 1, (n, d))
        tree = codes.Tree(x, leaf=8)
        for level, (at, up, number, total, radius) in enumerate(tree.levels):
            assert number.sum() == n and (total.sum(axis=0) == x.sum(axis=0)).all()
            gap = np.sqrt(((x - x[tree.net[at]]) ** 2).sum(axis=1))
            assert (gap <= radius[at] + 1e-9).all()  # every member lies within its node's radius
            if up is not None:
                assert (up[tree.levels[level + 1][0]] == at).all()  # subtrees are nested
        book = rng.integers(-wide, wide + 1, (64, d))
        book[9] = book[3]  # a tie
        code = np.empty(n, np.int64)
        number, total, exact = tree.assign(book, code)
        dist = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (code == dist.argmin(axis=1)).all()
        assert (number == np.bincount(code, minlength=64)).all()
        assert all((total[e] == x[code == e].sum(axis=0)).all() for e in range(64))
        assert exact < dist.size or n == 1 or wide == 2  # whole subtrees were given away


def test_query(spark):
    from quarry.llm.queries import ORACLES, QUERIES
    assert compare(QUERIES["op12_cover_tree_codes"](spark, SF_CHECK), duck(SF_CHECK), ORACLES["op12_cover_tree_codes"]) is None
