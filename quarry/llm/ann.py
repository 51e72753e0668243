"""Nearest neighbours by inner product with collision-counting hashing.

Vectors get one more component so that the largest inner product is the
smallest distance; every hash function is one projection, kept as a sorted
array. A query opens a window around its own value in every array; windows
widen by a constant factor (virtual rehashing: no new tables) until WANTED
neighbours' worth of vectors collide in at least ALPHA of the arrays. A sample
of the block's own vectors tells which widths are too narrow, so that the
collisions of the whole block are counted about once: by rank, for a vector
lies in a window if its rank does. If more collide than wanted, the threshold
rises until that many are left; their exact inner products with the original
vectors decide.

The work is dealt as (block of vectors) x (block of queries): both are bounded,
so a task holds a fixed amount whatever the table's size. Every row is indexed.
Blocks hold vectors of like norm (classes a quarter of an octave wide), so a
few long vectors never squeeze the others together; the number verified per
block and query is fixed by k. A query skips a class when even its largest
norm can't reach the query's k-th best product with the BOUND longest vectors:
an exact bound, nothing is lost by it. Equal vectors of a block are indexed
once, with all their ids, so a vector that makes up a third of the table
neither fills the candidates nor a window.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised

PROJECTIONS = 65
ALPHA = 0.85           # share of the projections in which a candidate collides
FIRST, WIDER = 1.0, 1.1  # first half width in units of a projection's spread, and the factor
WANTED = 80            # vectors verified per block and query, in units of k
SAMPLE = 512           # vectors of a block that tell the width
CLASSES = 4            # classes of norms per octave
BOUND = 2_048          # longest vectors, for the exact bound
BLOCK, QUERY_BLOCK = 16_384, 8_192
QUERIES_AT_ONCE = 256
SEED = 20


def usable(v: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


class Block:
    """Sorted projections of the distinct vectors of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, seed: int = SEED, projections: int = PROJECTIONS):
        by_id = np.argsort(ids, kind="stable")
        ids, vectors = ids[by_id], vectors[by_id]
        raw = np.ascontiguousarray(vectors + 0.0).view([("", vectors.dtype)] * vectors.shape[1]).ravel()  # + 0.0: one kind of zero
        _, first, group = np.unique(raw, return_index=True, return_inverse=True)
        self.vectors, self.dim = vectors[first], vectors.shape[1]
        members = np.argsort(group, kind="stable")  # ids ascending within a group
        self.ids, self.ends = ids[members], np.cumsum(np.bincount(group))
        scaled = self.vectors / norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        self.directions = _directions(self.dim + 1, projections, seed)
        values = np.ascontiguousarray((np.hstack([scaled, rest[:, None]]) @ self.directions).T)
        order = np.argsort(values, axis=1)
        self.sorted = np.take_along_axis(values, order, axis=1)
        n = len(self.vectors)
        kind = np.uint16 if n < 2 ** 16 else np.uint32
        self.rank = np.empty(order.shape, kind)  # place of each vector in each sorted array
        np.put_along_axis(self.rank, order, np.broadcast_to(np.arange(n, dtype=kind), order.shape), axis=1)
        self.some = np.ascontiguousarray(self.rank[:, np.random.default_rng(seed).permutation(n)[:SAMPLE]])

    def collisions(self, rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """In how many arrays each vector lies in the query's window (ranks low to high)."""
        low, width = low.astype(rank.dtype)[:, None], (high - low).astype(rank.dtype)[:, None]
        out = np.empty(rank.shape[1], np.uint8 if len(rank) < 256 else np.uint32)
        for a in range(0, len(out), 4096):
            out[a:a + 4096] = np.add.reduce((rank[:, a:a + 4096] - low < width).view(np.uint8), axis=0, dtype=out.dtype)
        return out

    def candidates(self, queries: np.ndarray, wanted: int) -> list[np.ndarray]:
        """Per query the distinct vectors that collide often enough, ``wanted`` of them (and ties) where there are so many."""
        n, m = len(self.vectors), len(self.sorted)
        found: list = [np.arange(n) if n <= wanted else None] * len(queries)
        at = np.hstack([queries / np.linalg.norm(queries, axis=1)[:, None], np.zeros((len(queries), 1))]) @ self.directions
        need, share = math.ceil(ALPHA * m), wanted * self.some.shape[1] / n
        half, open_ = FIRST / np.sqrt(self.dim + 1), np.array([i for i, f in enumerate(found) if f is None], np.int64)
        while len(open_):
            low = np.stack([np.searchsorted(s, x, "left") for s, x in zip(self.sorted, at[open_].T - half)], axis=1)
            high = np.stack([np.searchsorted(s, x, "right") for s, x in zip(self.sorted, at[open_].T + half)], axis=1)
            for i, lo, hi in zip(open_.tolist(), low, high):
                whole = half > 2  # everything lies in every window
                if whole or np.count_nonzero(self.collisions(self.some, lo, hi) >= need) >= share:
                    count = self.collisions(self.rank, lo, hi)
                    above = np.cumsum(np.bincount(count, minlength=m + 1)[::-1])[::-1]  # vectors with at least so many collisions
                    if whole or above[need] >= wanted:
                        found[i] = np.flatnonzero(count >= max(need, np.flatnonzero(above >= wanted)[-1]))
            open_ = np.array([i for i in open_.tolist() if found[i] is None], np.int64)
            half *= WIDER
        return found

    def nearest(self, queries: np.ndarray, own: list, k: int):
        """Per query ids and scores of the k nearest found, nearest first, ties to the smaller id; its ``own`` id is left out."""
        for a in range(0, len(queries), QUERIES_AT_ONCE):
            some = queries[a:a + QUERIES_AT_ONCE]
            for query, me, found in zip(some, own[a:a + QUERIES_AT_ONCE], self.candidates(some, (WANTED + 1) * k)):
                yield me, *self._best(query, me, found, k)

    def _best(self, query: np.ndarray, own: int, found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        score = (self.vectors[found] * query).sum(axis=1)  # the same for equal vectors, whatever stands beside them
        if len(found) > k + 1:
            least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
            found, score = found[score >= least], score[score >= least]
        ids, scores = [], []
        for g, s in zip(found.tolist(), score.tolist()):
            start = self.ends[g - 1] if g else 0
            some = self.ids[start:min(self.ends[g], start + k + 1)]
            ids.append(some[some != own])
            scores.append(np.full(len(ids[-1]), s))
        ids, scores = np.concatenate(ids), np.concatenate(scores)
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]


def _directions(dim: int, n: int, seed: int) -> np.ndarray:
    """Random unit directions, orthogonal as far as the dimension allows."""
    rng = np.random.default_rng(seed)
    return np.hstack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-n // dim))])[:, :n]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, query: Column | None = None,
            block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for every query row (those whose
    id is divisible by 20, unless ``query`` says otherwise), against all rows.

    Vectors null, empty, zero, or holding null or non-finite components, and
    rows without an id, take no part. Rows repeated under one id count once
    (different vectors under one id: the largest in component order). Vectors
    meet only those of their own dimension. A query with fewer than k others
    gets them all. Empty input: no rows.
    """
    clean = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
             .where(F.col("id").isNotNull() & usable(F.col("v"))).groupBy("id").agg(F.max("v").alias("v")))
    # written once: five reads follow, and the largest component must not be worked out again within the sum over components
    clean = materialised(clean.select("id", "v", F.size("v").alias("dim"), F.array_max(F.transform("v", F.abs)).alias("most")), "nearest-vectors")
    norm = F.col("most") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("most")) * (x / F.col("most"))))
    clean = clean.select("id", "v", "dim", norm.alias("norm"))
    clean = clean.withColumn("class", F.floor(F.log2("norm") * CLASSES + 0.5))  # the norm 1 lies within a class, not between two
    asked = F.col("id") % 20 == 0 if query is None else query
    # one row per dimension and class (a few thousand at most: doubles have 2,100 octaves): its blocks and largest norm; per dimension: query blocks
    parts = clean.groupBy("dim", "class").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"), (F.max("norm") * (1 + 1e-9)).alias("top"))
    asks = clean.where(asked).groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / query_block).alias("query_blocks"))
    members = clean.join(parts, ["dim", "class"]).join(asks, "dim").select(
        "dim", "class", "top", "id", "v", F.pmod(F.xxhash64("id"), "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)).alias("query_block"))
    queries = (_with_bound(clean.where(asked).select("id", "v", "dim", "norm"), clean, k).join(asks, "dim").join(parts, "dim")
               .where(F.col("bound").isNull() | (F.col("norm") * F.col("top") >= F.col("bound"))).select(
        F.col("dim").alias("q_dim"), F.col("class").alias("q_class"), F.col("id").alias("q_id"), F.col("v").alias("q_v"),
        F.pmod(F.xxhash64("id", F.lit(1)), "query_blocks").alias("q_query_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("q_block")))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = [[], [], []]
        if len(left) and len(right):
            index = Block(left["id"].to_numpy(), _matrix(left["v"]), left["top"][0].as_py())
            for own, ids, scores in index.nearest(_matrix(right["q_v"]), right["q_id"].to_pylist(), k):
                out[0].append(np.full(len(ids), own))
                out[1].append(ids)
                out[2].append(scores)
        cols = [np.concatenate(c) if c else np.empty(0) for c in out]
        return pa.table({"query_id": pa.array(cols[0].astype(np.int64)), "vec_id": pa.array(cols[1].astype(np.int64)), "score": pa.array(cols[2].astype(np.float64))})

    found = (members.groupBy("dim", "class", "block", "query_block").cogroup(queries.groupBy("q_dim", "q_class", "q_block", "q_query_block"))
             .applyInArrow(search, "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_bound(queries: DataFrame, clean: DataFrame, k: int) -> DataFrame:
    """The queries with ``bound``: what any k-th best product reaches at least,
    from the BOUND longest vectors (that many rows go to the tasks); null where they don't tell."""
    longest = clean.select("id", "v", "norm").orderBy(F.col("norm").desc(), "id").limit(BOUND).select("id", "v").toArrow()
    ids, vectors = longest["id"].to_numpy(), longest["v"].to_pylist()
    by_dim = {d: [i for i, v in enumerate(vectors) if len(v) == d] for d in {len(v) for v in vectors}}
    known = {d: (ids[at], np.array([vectors[i] for i in at], np.float64)) for d, at in by_dim.items() if len(at) > k}

    def run(batches):
        for b in batches:
            bound = []
            for own, v in zip(b.column("id").to_pylist(), b.column("v")):
                at, rows = known.get(len(v), (None, None))
                if at is None:
                    bound.append(None)
                    continue
                score = (rows @ v.values.to_numpy())[at != own]
                least = float(np.partition(score, len(score) - k)[len(score) - k])
                bound.append(least - 1e-9 * abs(least) if math.isfinite(least) else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bound, pa.float64())], names=[*b.schema.names, "bound"])

    return queries.mapInArrow(run, "id long, v array<double>, dim int, norm double, bound double")
