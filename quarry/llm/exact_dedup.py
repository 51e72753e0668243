"""Exact deduplication by Grace hashing.

Records are dealt by the hash of their content (Spark's shuffle is the first
partitioning); inside a task a bucket that outgrows its memory budget is
partitioned again, by the next bits of the hash, into spill files, recursively,
until it fits an open-addressing table that compares complete contents.

Copies are merged before the shuffle by the same table (flushed when full), so
a text that makes up a third of all rows sends one row per task. Spill files
are anonymous (already unlinked) files of the task itself: nothing is shared
through them, a retried task writes its own, and none outlives its task.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, materialised, one_of_each, only, text_or_empty

BUDGET_BYTES = 96 << 20
FAN_OUT_BITS = 4
OUT_ROWS = 2_000
OUT_BYTES = 16 << 20


class ContentTable:
    """Open addressing with linear probing; equal means equal complete content.

    An entry is [hash, content, digest, smallest id, copies]."""

    def __init__(self, slots: int = 1 << 10):
        self.slots, self.entries, self.bytes = [-1] * slots, [], 0

    def find(self, h: int, content: str) -> tuple[int, int]:
        """Slot and entry number; entry -1: absent, the slot is free."""
        mask, i = len(self.slots) - 1, h & (len(self.slots) - 1)
        while (e := self.slots[i]) >= 0:
            entry = self.entries[e]
            if entry[0] == h and entry[1] == content:
                return i, e
            i = (i + 1) & mask
        return i, -1

    def add(self, row: tuple, room: bool = True) -> bool:
        """Merge a row into its entry, or make one; False if it is new and there is no room."""
        h, content, digest, least, copies = row
        slot, e = self.find(h, content)
        if e >= 0:
            entry = self.entries[e]
            entry[4] += copies
            if least is not None and (entry[3] is None or least < entry[3]):
                entry[3] = least
            return True
        if not room:
            return False
        self.slots[slot] = len(self.entries)
        self.entries.append([h, content, digest, least, copies])
        self.bytes += 4 * len(content) + 200  # a string holds up to four bytes a character
        if 2 * len(self.entries) > len(self.slots):
            self._grow()
        return True

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for n, entry in enumerate(self.entries):
            i = entry[0] & mask
            while self.slots[i] >= 0:
                i = (i + 1) & mask
            self.slots[i] = n


def grace(rows: Iterator[tuple], budget: int, bit: int = 0, spilled: list | None = None) -> Iterator[list]:
    """Distinct contents of the rows. New contents beyond the budget go to one
    of 2**FAN_OUT_BITS spill files by the hash bits above ``bit``; each file is
    then a bucket of its own. After the last bits a bucket holds contents of
    one hash only and is kept whole. ``spilled`` collects the depths (tests)."""
    table, files, fan = ContentTable(), {}, (1 << FAN_OUT_BITS) - 1
    for row in rows:
        if not table.add(row, table.bytes < budget or bit >= 64):
            part = (row[0] >> bit) & fan
            if part not in files:
                files[part] = tempfile.TemporaryFile()
                if spilled is not None:
                    spilled.append(bit)
            pickle.dump(row, files[part], protocol=5)
    yield from table.entries
    del table
    for f in files.values():
        f.seek(0)
        with f:
            yield from grace(_read(f), budget, bit + FAN_OUT_BITS, spilled)


def _read(f) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for lo in range(0, b.num_rows, OUT_ROWS):
            cols = [c.to_pylist() for c in b.slice(lo, OUT_ROWS).columns]
            # the signed hash becomes unsigned: its bits choose buckets and slots
            for h, *rest in zip(*cols):
                yield (h & 0xFFFFFFFFFFFFFFFF, *rest)


def _batches(entries: Iterator[list], schema: pa.Schema, keep: list[int]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    for e in entries:
        out.append([signed(e[0]), *e[1:]])
        size += len(e[1])
        if len(out) >= OUT_ROWS or size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in zip(keep, schema)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in zip(keep, schema)], schema=schema)


LOCAL = pa.schema([("h", pa.int64()), ("content", pa.string()), ("text_sha256", pa.string()), ("least", pa.int64()), ("copies", pa.int64())])
CLASSES = pa.schema([("h", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def contents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, normalised content, its 64-bit hash and SHA-256: all in the JVM."""
    norm = F.regexp_replace(text_or_empty(text_col), SPACE, " ")
    return (only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), norm.alias("content"))
            .select("doc_id", "content", F.xxhash64("content").alias("h"), F.sha2(F.col("content").cast("binary"), 256).alias("text_sha256")))


def distinct_contents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET_BYTES) -> DataFrame:
    """One row per distinct content: h, text_sha256, keep_id, group_size."""
    rows = contents(docs, id_col, text_col).select("h", "content", "text_sha256", F.col("doc_id").alias("least"), F.lit(1).cast("long").alias("copies"))

    def merge_local(batches):
        def flushed():
            table = ContentTable()
            for row in _rows(batches):
                if table.bytes >= budget:
                    yield from table.entries
                    table = ContentTable()
                table.add(row)
            yield from table.entries
        yield from _batches(flushed(), LOCAL, [0, 1, 2, 3, 4])

    def merge(batches):
        yield from _batches(grace(_rows(batches), budget), CLASSES, [0, 2, 3, 4])

    local = rows.mapInArrow(merge_local, "h long, content string, text_sha256 string, least long, copies long")
    return local.repartition("h").mapInArrow(merge, "h long, text_sha256 string, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after every run of white space becomes one
    space; a null text is the empty text. keep_id is the smallest id of the
    group (null only if no copy has an id). kept: the row carries keep_id, so
    rows repeated with the same id and text are one document and all kept; a
    row without an id is kept only where the whole group has none. The classes are joined
    back by hash and digest, which the table found to be one content each; a
    hot digest is split by Spark's skew handling. Empty input: no rows.
    """
    classes = distinct_contents(docs, id_col, text_col, budget)
    members = contents(docs, id_col, text_col).select("doc_id", "h", "text_sha256")
    return (members.join(classes, ["h", "text_sha256"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns: the row that
    carries keep_id. Where several rows do (an id loaded twice, or no row of
    the group has an id), the smallest of them in column order stays."""
    found = materialised(exact_dedup(docs, id_col, text_col).select("doc_id", "kept", "text_sha256"), "dedup-rows")
    once = found.groupBy("text_sha256").agg(F.count_if("kept").alias("n"))
    many = found.where("kept").join(once.where("n > 1"), "text_sha256")
    key = [F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")]
    decided = materialised(found.where("not kept").select(*key, F.lit(None).cast("string").alias("keep_as"))
                           .unionAll(many.select(*key, F.col("text_sha256").alias("keep_as"))).distinct(), "dedup-decided")
    sha = F.sha2(F.regexp_replace(text_or_empty(text_col), SPACE, " ").cast("binary"), 256)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), sha.alias("sha"))
    return one_of_each(keyed, decided, (F.col("sha") == F.col("_sha")) & F.col("id").eqNullSafe(F.col("_id")))
