"""Vector code compression: product codes learnt by Lloyd rounds over cover trees.

Components become floor(256 x); a vector is cut into PARTS equal parts; each
part position has a codebook of ENTRIES entries. All arithmetic that decides
anything is in integers.

1. Rows are packed into blocks of BLOCK vectors, in the partition where they
   lie. Each block has one cover tree per part position: nested nets whose
   radius halves from level to level; every node knows its exact radius, its
   number of points and their sum. Nets end where a node holds at most LEAF
   points. Blocks are written once as Parquet; every round reads them again.
2. A round walks the trees of each block from the root, all nodes of a level
   at once. With d the distance of an entry to the node's point and r the
   node's radius, an entry with d > d_nearest + 2 r is the nearest of no
   point below; if one entry is left, the whole subtree goes to it by its sum
   and number. Ambiguous nodes descend with the entries left; in the leaves
   the exact squared distances decide, ties to the lower index.
3. Sums and numbers per (part, entry) are added up by Spark; the new codebook
   (PARTS x ENTRIES rows at most) is the only thing that reaches the driver.
4. The same walk gives the final codes.

Vectors that are null, hold null or non-finite components, have another length
than the first kept vector (smallest vec_id), or whose floor(256 x) leaves
+-2^28 (exact sums end there) take no part; lengths must be a multiple of
PARTS. Ties of vec_id are ordered by the vector; null ids come last. With
fewer kept vectors than ENTRIES the codebooks have that many entries. No kept
vector: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK, LEAF = 2048, 16
LARGEST = 1 << 28
SLACK = 1e-6  # more than the rounding of the square roots below


class Tree:
    """Cover tree over the rows of ``points`` (n, d): explicit nodes per level, level 0 the root."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        n = len(points)
        net, of = [0], np.zeros(n, np.int64)  # net points in order of insertion; each row's nearest one
        far = ((points - points[0]) ** 2).sum(axis=1)
        reach = float(np.sqrt(far.max()))
        parent, sizes = [0], [1]  # net point above a net point when it came; net size at each level
        while reach >= 1:
            reach /= 2
            limit, old = reach * reach, np.array(of)
            while True:
                open_ = far > limit
                open_ &= np.bincount(of, minlength=len(net))[of] > leaf
                if not open_.any():
                    break
                new = int(np.argmax(open_))
                parent.append(int(old[new]))
                net.append(new)
                d = ((points - points[new]) ** 2).sum(axis=1)
                closer = d < far
                of[closer], far[closer] = len(net) - 1, d[closer]
            if len(net) > sizes[-1]:
                sizes.append(len(net))
            if np.bincount(of).max() <= leaf:
                break
        self.points, self.net, self.parent = points, np.array(net), np.array(parent)
        self.sizes, self.of = sizes, of
        self._fill()

    def _fill(self):
        """Members, radius, number and sum of every node, from the leaves up."""
        self.levels = []
        at = self.of
        for level in range(len(self.sizes) - 1, -1, -1):
            size = self.sizes[level]
            if level < len(self.sizes) - 1:
                up = np.arange(self.sizes[level + 1])
                late = up >= size  # came below this level
                up[late] = self.parent[late.nonzero()[0]]
                while (up >= size).any():  # its parent came below too
                    up = np.where(up >= size, self.parent[up], up)
                at = up[at]
            else:
                up = None
            number = np.bincount(at, minlength=size)
            total = np.zeros((size, self.points.shape[1]), np.int64)
            np.add.at(total, at, self.points)
            far = np.zeros(size, np.int64)
            np.maximum.at(far, at, ((self.points - self.points[self.net[at]]) ** 2).sum(axis=1))
            self.levels.append((at, up, number, total, np.sqrt(far.astype(np.float64))))
        self.levels.reverse()  # (node of each row, node above each node of the next level, number, sum, radius)

    @classmethod
    def stored(cls, points, net, parent, sizes, of):
        tree = cls.__new__(cls)
        tree.points, tree.net, tree.parent, tree.sizes, tree.of = points, net, parent, list(sizes), of
        tree._fill()
        return tree

    def assign(self, book: np.ndarray, code: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, sum) per entry of ``book`` (k, d), and the exact comparisons
        made in leaves; with ``code``, the entry of every row is written there."""
        k = len(book)
        number, total = np.zeros(k, np.int64), np.zeros((k, book.shape[1]), np.int64)
        nodes, left, exact = np.zeros(1, np.int64), np.ones((1, k), dtype=bool), 0
        for level, (at, up, count, sums, radius) in enumerate(self.levels):
            own = self.points[self.net[nodes]]
            d = np.sqrt(((own[:, None, :] - book[None, :, :]) ** 2).sum(axis=2).astype(np.float64))
            d[~left] = np.inf
            left &= d <= d.min(axis=1, keepdims=True) * (1 + 1e-12) + 2 * radius[nodes][:, None] + SLACK
            sure = left.sum(axis=1) == 1
            entry = left.argmax(axis=1)
            np.add.at(number, entry[sure], count[nodes[sure]])
            np.add.at(total, entry[sure], sums[nodes[sure]])
            if code is not None and sure.any():
                given = np.full(len(count), -1, np.int64)
                given[nodes[sure]] = entry[sure]
                mine = given[at]
                code[mine >= 0] = mine[mine >= 0]
            nodes, left = nodes[~sure], left[~sure]
            if not len(nodes):
                return number, total, exact
            place = np.full(len(count), -1, np.int64)
            place[nodes] = np.arange(len(nodes))
            if level + 1 < len(self.levels):
                above = self.levels[level][1]
                nodes = np.flatnonzero(place[above] >= 0)
                left = left[place[above[nodes]]]
        rows = np.flatnonzero(place[at] >= 0)
        left = left[place[at[rows]]]
        d = ((self.points[rows][:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        d[~left] = np.iinfo(np.int64).max
        entry = d.argmin(axis=1)  # the first of equal ones
        np.add.at(number, entry, 1)
        np.add.at(total, entry, self.points[rows])
        if code is not None:
            code[rows] = entry
        return number, total, int(left.sum())


def kept(vectors: DataFrame) -> tuple[DataFrame, int, np.ndarray]:
    """(usable rows as vec_id, label, v (integers); length; first codebooks (PARTS, k, d))."""
    x = F.transform(F.col("`embedding`"), lambda c: F.floor(c.cast("double") * SCALE))
    fine = F.forall(F.col("`embedding`"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST / SCALE - 1))
    label = F.col("`label`").cast("string") if "label" in vectors.columns else F.lit(None).cast("string")
    rows = (vectors.select(F.col("`vec_id`").alias("vec_id"), label.alias("label"), F.when(fine, x).alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0)))
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    head = rows.orderBy(*order).limit(1).select(F.size("v")).collect()
    if not head:
        return rows, 0, np.zeros((PARTS, 0, 0), np.int64)
    length = head[0][0]
    if length % PARTS:
        raise ValueError(f"vectors of {length} components can't be cut into {PARTS} equal parts")
    rows = rows.where(F.size("v") == length)
    first = rows.orderBy(*order).limit(ENTRIES).select("v").collect()  # at most ENTRIES rows
    book = np.array([r.v for r in first], np.int64).reshape(len(first), PARTS, length // PARTS)
    return rows, length, book.transpose(1, 0, 2).copy()


_BLOCK = "ids array<{kind}>, labels array<string>, v array<int>, net array<array<int>>, parent array<array<int>>, sizes array<array<int>>, of array<array<int>>"


def blocks(rows: DataFrame, length: int, block: int = BLOCK) -> DataFrame:
    """One row per block: its vectors and, per part position, its cover tree."""
    kind, part = rows.schema["vec_id"].dataType.simpleString(), length // PARTS
    lists = pa.list_(pa.list_(pa.int32()))

    def pack(ids, labels, v):
        flat = v.flatten().to_numpy().astype(np.int64).reshape(len(ids), PARTS, part)
        trees = [Tree(np.ascontiguousarray(flat[:, p])) for p in range(PARTS)]
        cols = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in (ids, labels, pa.array(flat.ravel().astype(np.int32)))]
        cols += [pa.array([[np.asarray(getattr(t, f), np.int32) for t in trees]], lists) for f in ("net", "parent", "sizes", "of")]
        return pa.RecordBatch.from_arrays(cols, names=["ids", "labels", "v", "net", "parent", "sizes", "of"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            while n >= block:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield pack(*whole.slice(0, block).columns)
                held, n = [whole.slice(block)], n - block
        if n:
            yield pack(*pa.Table.from_batches([h for h in held if h.num_rows]).combine_chunks().to_batches()[0].columns)

    return rows.select("vec_id", "label", F.transform("v", lambda c: c.cast("int")).alias("v")).mapInArrow(run, _BLOCK.format(kind=kind))


def _trees(b: pa.RecordBatch, i: int, part: int):
    n = len(b.column("ids")[i])
    flat = b.column("v")[i].values.to_numpy().astype(np.int64).reshape(n, PARTS, part)
    for p in range(PARTS):
        yield p, Tree.stored(np.ascontiguousarray(flat[:, p]), *(b.column(f)[i].values[p].values.to_numpy().astype(np.int64) for f in ("net", "parent", "sizes", "of")))


def lloyd_round(packed: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after one round: floor(sum / number) per entry, unused entries as they were."""
    part = book.shape[2]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                rows = []
                for p, tree in _trees(b, i, part):
                    number, total, _ = tree.assign(book[p])
                    rows += [(p, e, int(number[e]), total[e]) for e in np.flatnonzero(number)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                                  pa.array(cols[3], pa.list_(pa.int64()))], names=["part", "entry", "number", "total"])

    sums = [F.sum(F.col("total")[c]).alias(f"c{c}") for c in range(part)]
    new = book.copy()
    for r in packed.mapInArrow(run, "part int, entry int, number long, total array<long>").groupBy("part", "entry").agg(F.sum("number").alias("number"), *sums).collect():
        new[r.part, r.entry] = [r[f"c{c}"] // r.number for c in range(part)]  # at most PARTS x ENTRIES rows
    return new


def coded(packed: DataFrame, book: np.ndarray, kind: str) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    part = book.shape[2]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                codes, error = [], 0
                for p, tree in _trees(b, i, part):
                    code = np.empty(len(tree.points), np.int64)
                    tree.assign(book[p], code)
                    error = error + ((tree.points - book[p][code]) ** 2).sum(axis=1)
                    codes.append(code)
                text = [bytes(c).hex() for c in np.stack(codes, axis=1).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([b.column("ids")[i].values, b.column("labels")[i].values, pa.array(text), pa.array(error, pa.int64())],
                                                 names=["vec_id", "label", "code", "error"])

    return packed.mapInArrow(run, f"vec_id {kind}, label string, code string, error long")


def learn(vectors: DataFrame, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """(blocks with their trees, final codebooks (PARTS, k, d)); no kept vector: codebooks without entries."""
    rows, length, book = kept(vectors)
    if not length:
        return rows, book
    packed = materialised(blocks(rows, length, block), "codes-blocks")
    for _ in range(ROUNDS):
        book = lloyd_round(packed, book)
    return packed, book


def vector_codes(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per kept row of (vec_id, embedding, label): code, squared error, the error of all
    rows with its label (nulls together), and the digest of the codebooks."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    packed, book = learn(vectors, block)
    if not book.size:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    rows = materialised(coded(packed, book, kind), "codes-rows")
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of the whole result: the rounds unrolled, every distance computed."""
    sql = [f"""
        WITH e AS (SELECT vec_id, label, [floor(x::DOUBLE * {scale})::BIGINT FOR x IN embedding] AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
             p AS (SELECT vec_id, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x FROM e, range({parts}) r(part)),
             f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e QUALIFY entry < {entries}),
             b0 AS (SELECT part, entry, x AS c FROM p JOIN f USING (vec_id))"""]
    for k in range(rounds + 1):
        sql.append(f"""
             d{k} AS (SELECT vec_id, p.part, entry, x, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x, c)])::BIGINT AS dist
                      FROM p JOIN b{k} ON p.part = b{k}.part),
             a{k} AS MATERIALIZED (SELECT vec_id, part, min(dist) AS dist, arg_min(entry, dist * {entries} + entry) AS entry, any_value(x) AS x
                                   FROM d{k} GROUP BY vec_id, part)""")
        if k < rounds:
            sql.append(f"""
             t{k} AS (SELECT part, entry, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS c
                      FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY part, entry, i),
             u{k} AS (SELECT part, entry, list(c ORDER BY i) AS c FROM t{k} GROUP BY part, entry),
             b{k + 1} AS MATERIALIZED (SELECT b{k}.part, b{k}.entry, coalesce(u{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN u{k} USING (part, entry))""")
    return ",".join(sql) + f""",
             g AS (SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
             s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM g JOIN e USING (vec_id), s"""
