"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints at most ``max_bits`` apart agree in at least two of five blocks
of bits, so every distinct fingerprint is dealt under ten keys (each pair of
blocks). Inside a key the fingerprints stand in Gray order, where neighbours
share most bits; the index over them keeps in each upper node the mask and
pattern of the bits that all below share (less those its own parent holds). A
search adds up the differences on the way down and prunes a whole group as
soon as they exceed the limit. Found links are reduced to a forest per key, and
the components of all forests are found by star contraction on tables below
spark.checkpoint.dir; no links are gathered on the driver.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialised, one_of_each, only, text_or_empty

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit and width
FAN_OUT = 8
QUERY_CHUNK = 256
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half the XXH64 of the shingles (repeats
    included); fewer words than a shingle are one shingle, none give zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z changes, ASCII white space splits
    if not words:
        return 0
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[:n - 1] + 1]).tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for lo in range(0, n, SHINGLES_AT_ONCE):
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[lo:lo + SHINGLES_AT_ONCE], stops[lo:lo + SHINGLES_AT_ONCE])], dtype="<u8")
        # eight bit planes at a time: byte k of every hash, counted by value
        for k in range(8):
            ones[8 * k:8 * k + 8] += np.bincount(h.view(np.uint8)[k::8], minlength=256) @ _BITS
    return sum(1 << i for i, c in enumerate(ones.tolist()) if 2 * c > n)


_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row_key (hash of the text: tells rows of one id apart), fp (64 bits as a signed long)."""
    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("row_key"), "text")

    def run(batches):
        for b in batches:
            out = []
            col = b.column(2)
            for lo in range(0, b.num_rows, 256):
                out += [fingerprint(t, shingle) for t in col.slice(lo, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(out, dtype=np.uint64).view(np.int64))], names=["doc_id", "row_key", "fp"])

    return rows.mapInArrow(run, "doc_id long, row_key long, fp long")


def gray_rank(fp: Column) -> Column:
    """Position of a word in the reflected Gray code."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


class GrayIndex:
    """Hierarchy over fingerprints in Gray order; groups of FAN_OUT form a node of the next level."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        ones, zeros = fps, ~fps  # bits set (clear) in all below
        raw = []
        while len(ones) > 1 or not raw:
            pad = -len(ones) % FAN_OUT
            full = np.uint64(0xFFFFFFFFFFFFFFFF)
            ones = np.bitwise_and.reduce(np.append(ones, np.full(pad, full)).reshape(-1, FAN_OUT), axis=1)
            zeros = np.bitwise_and.reduce(np.append(zeros, np.full(pad, full)).reshape(-1, FAN_OUT), axis=1)
            raw.append((ones | zeros, ones))
        #: from the top: mask of the bits not yet held above, and their pattern
        self.levels, above = [], None
        for mask, pattern in reversed(raw):
            own = mask if above is None else mask & ~np.repeat(above, FAN_OUT)[:len(mask)]
            self.levels.append((own, pattern & own))
            above = mask
        self.leaf_mask = ~np.repeat(above, FAN_OUT)[:len(fps)]

    def search(self, first: int, last: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member) with first <= query < last, query < member, within max_bits."""
        q = np.arange(first, last)
        node, diff = np.zeros(len(q), dtype=np.int64), np.zeros(len(q), dtype=np.int64)
        span = FAN_OUT ** len(self.levels)
        for depth, (mask, pattern) in enumerate([*self.levels, (self.leaf_mask, self.fps & self.leaf_mask)]):
            if depth:
                q, diff = np.repeat(q, FAN_OUT), np.repeat(diff, FAN_OUT)
                node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                span //= FAN_OUT
                there = (node < len(mask)) & ((node + 1) * span > q + 1)  # a group with members behind the query
                q, node, diff = q[there], node[there], diff[there]
            diff = diff + np.bitwise_count((self.fps[q] ^ pattern[node]) & mask[node])
            near = diff <= max_bits
            q, node, diff = q[near], node[near], diff[near]
        return q, node


def forest(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, first member of its component) among fingerprints in Gray order."""
    root = np.arange(len(fps))
    index = GrayIndex(fps)
    for lo in range(0, len(fps), QUERY_CHUNK):
        a, b = index.search(lo, min(lo + QUERY_CHUNK, len(fps)), max_bits)
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (up := root[root]).tolist() != root.tolist():
                root = up
    member = np.flatnonzero(root != np.arange(len(fps)))
    return fps[member], fps[root[member]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """u, v: links among distinct fingerprints (column fp) that connect exactly
    those within max_bits (at most 3, by the choice of keys)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("five blocks find pairs up to 3 bits apart")
    part = [F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit((1 << width) - 1)) for lo, width in BLOCKS]
    keys = [F.shiftleft(F.shiftleft(F.lit(k).cast("long"), 13).bitwiseOR(part[i]), 13).bitwiseOR(part[j]) for k, (i, j) in enumerate(combinations(range(5), 2))]
    dealt = (distinct.select("fp", F.explode(F.array(*keys)).alias("key")).repartition("key")
             .sortWithinPartitions("key", F.expr("1L << 63").bitwiseXOR(gray_rank(F.col("fp")))))

    def run(batches):
        held_key, held = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            key = b.column(1).to_numpy(zero_copy_only=False)
            held_key, held = np.concatenate([held_key, key]), np.concatenate([held, fp])
            cut = np.searchsorted(held_key, held_key[-1])  # the last key may go on in the next batch
            yield from found(held_key[:cut], held[:cut])
            held_key, held = held_key[cut:], held[cut:]
        yield from found(held_key, held)

    def found(key, fp):
        if not len(key):
            return
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        us, vs = [], []
        two = first[size == 2]
        near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits]
        us.append(fp[near + 1])
        vs.append(fp[near])
        for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            u, v = forest(fp[at:at + n], max_bits)
            us.append(u)
            vs.append(v)
        u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return dealt.mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, root for the nodes of the links (u, v): root is the smallest node
    of its component. Large-star and small-star steps in turn until nothing
    changes; each round is written to the shared folder. Only two numbers a
    round come to the driver."""
    def both(e):
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def mark(e):
        return e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()

    edges = materialised(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), name)
    before = mark(edges)
    while before["n"]:
        # large star: neighbours above a node move to the smallest of its neighbours and itself
        least = both(edges).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both(edges).join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: a node and its neighbours below move to the smallest of these
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v"))).distinct())
        edges = materialised(small, name)
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id
    (smallest id among all rows reachable by links, its own included).

    A null text is the empty text, whose fingerprint is zero and linked like any
    other. Rows without an id take part; component_id is null only where no row
    of the component has an id. Empty input: no rows.
    """
    return groups_of(materialised(fingerprints(docs, id_col, text_col, shingle), "simhash-fp"), max_bits).drop("row_key", "root")


def groups_of(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The groups of rows (doc_id, row_key, fp)."""
    distinct = materialised(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct, max_bits), "simhash-links")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id", "root")
    return rows.join(by_fp, "fp").select("doc_id", "row_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, with all its columns: the row whose id names the
    group. Where several rows do (an id loaded twice, or no row of the group
    has an id), the smallest of them in column order stays."""
    rows = materialised(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    found = materialised(groups_of(rows, max_bits).select("doc_id", "row_key", "root", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")), "simhash-rows")
    once = found.groupBy("root").agg(F.count_if("kept").alias("n"))
    many = found.where("kept").join(once.where("n > 1"), "root")
    key = [F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")]
    decided = materialised(found.where("not kept").select(*key, F.lit(None).cast("long").alias("keep_as"))
                           .unionAll(many.select(*key, F.col("root").alias("keep_as"))).distinct(), "simhash-decided")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.xxhash64(text_or_empty(text_col)).alias("key"))
    return one_of_each(keyed, decided, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
