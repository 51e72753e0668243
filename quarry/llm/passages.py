"""Passages that repeat across documents, by a sparse suffix array.

Only suffixes that begin at a minimiser are kept: of every WINDOW consecutive
SEED-word grams the one with the smallest hash. Any passage of
WINDOW + SEED - 1 = MIN_WORDS words holds such a position, and equal passages
hold it at the same place. Seeds that stand in one text alone are put aside by
a count; the suffixes of the rest are sorted (Spark's range partitioning on the
suffix itself, so a passage in a third of all texts spreads over many tasks) and
neighbours from different texts are compared: the match is extended to the right
and to the left of the seed, and counts from MIN_WORDS words on. Each suffix
carries the words a passage of MIN_WORDS can reach; longer passages come out as
overlapping matches of several seeds and are merged.

Where a seed has more texts than a suffix has neighbours, a text's only partner
may stand farther away in the order. There the windows of MIN_WORDS words that
hold the seed are compared by a 128-bit hash, all with all; runs of a seed that
lie in several tasks hand their windows to a grouping by that hash. So every
repeated window of MIN_WORDS words is found.

Texts that are equal take part once; whole copies are found by their hash.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised, only, text_or_empty

MIN_WORDS = 50
SEED = 12
WINDOW = MIN_WORDS - SEED + 1
CHUNK = 1 << 18   # grams handled at once
NEAR = 4          # texts before a suffix that it is compared with
RUN = 20_000      # rows of one seed whose windows are compared together
HELD = 5_000      # rows after which windows are compared, at least
_BASE = np.uint64(0x9E3779B97F4A7C15)  # fixed value: 2**64 over the golden ratio, odd
_BASE_2 = np.uint64(0xC2B2AE3D27D4EB4F)  # fixed value: an odd multiplier of XXH64, for the second half of a window's hash


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # bytes: ASCII white space only


def minimisers(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept suffixes, and the hash of the gram at each."""
    n = len(words) - SEED + 1
    if len(words) < MIN_WORDS:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    gram = np.zeros(n, dtype=np.uint64)
    for k in range(SEED):
        gram = gram * _BASE + one[k:k + n]
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    gram ^= gram >> np.uint64(32)
    found = []
    for lo in range(0, n - WINDOW + 1, CHUNK):
        part = gram[lo:lo + CHUNK + WINDOW - 1]
        found.append(np.unique(np.lib.stride_tricks.sliding_window_view(part, WINDOW).argmin(axis=1) + np.arange(len(part) - WINDOW + 1)) + lo)
    at = np.unique(np.concatenate(found))
    return at, gram[at].view(np.int64)


def _match(a: list, b: list) -> tuple[int, int]:
    """Equal words to the right (from the seed on) and to the left of two suffixes."""
    return _common(a[0], b[0]), _common(a[1], b[1])


def _common(x: list, y: list) -> int:
    if x == y:
        return len(x)
    n = 0
    for p, q in zip(x, y):
        if p != q:
            break
        n += 1
    return n


class Neighbours:
    """Feeds rows in suffix order: each meets the nearest rows before it of up to
    NEAR other texts that share its seed; matches are (text, start, end, id of the other)."""

    def __init__(self):
        self.near: list[list] = []  # one row per text, the latest last
        self.matches: list[tuple] = []

    def feed(self, row: list) -> None:
        if self.near and self.near[-1][0][:SEED] != row[0][:SEED]:
            self.near = []
        self.near = [r for r in self.near if r[2] != row[2]][-NEAR:]
        for r in self.near:
            self.pair(r, row)
        self.near.append(row)

    def pair(self, a: list, b: list) -> None:
        right, left = _match(a, b)
        if right >= SEED and right + left >= MIN_WORDS:
            self.matches.append((a[2], a[3] - left, a[3] + right, b[4]))
            self.matches.append((b[2], b[3] - left, b[3] + right, a[4]))


SEEDS_SQL = "text_key long, pos long, seed long, doc_id long, n_words long, alt long"
FOUND = pa.schema([("text_key", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("other_id", pa.int64()), ("window", pa.int64()), ("window_2", pa.int64())])
FOUND_SQL = "text_key long, first long, last long, other_id long, window long, window_2 long"


def _windows(rows: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both halves of the hashes of the MIN_WORDS-word windows that hold each row's
    seed, and which of them the row's text has; column i begins WINDOW - 1 - i words
    before the seed. The halves come from independent halves of the words' 128-bit hashes."""
    known = {w: divmod(xxhash.xxh3_128_intdigest(w), 1 << 64) for w in {w for r in rows for side in r[:2] for w in side}}
    halves = []
    for half, base in ((1, _BASE), (0, _BASE_2)):
        one = {w: h[half] for w, h in known.items()}
        words = np.zeros((len(rows), WINDOW + MIN_WORDS), dtype=np.uint64)
        for i, (right, left, *_) in enumerate(rows):
            words[i, WINDOW:WINDOW + len(right)] = np.fromiter(map(one.__getitem__, right), np.uint64, len(right))
            words[i, WINDOW - len(left):WINDOW] = np.fromiter(map(one.__getitem__, reversed(left)), np.uint64, len(left))
        out = np.zeros((len(rows), WINDOW), dtype=np.uint64)
        for k in range(1, MIN_WORDS + 1):
            out = out * base + words[:, k:k + WINDOW]
        halves.append(out)
    before = np.arange(WINDOW - 1, -1, -1)
    there = (before <= np.array([len(r[1]) for r in rows])[:, None]) & (MIN_WORDS - before <= np.array([len(r[0]) for r in rows])[:, None])
    return *halves, there


def _same_windows(rows: list[list], is_open: np.ndarray) -> tuple[list, list]:
    """Matches of windows that rows of different texts share: (text, start, end,
    id of another), one per stretch of consecutive windows. And the windows of
    open rows as (text, start, end, id, both halves of the window's hash), for the rows of their seed in other
    runs: all those that no other text here has, and one of each that some has."""
    low, high, there = _windows(rows)
    row, col = np.nonzero(there)
    if not len(row):
        return [], []
    key, key_2, text = low[row, col], high[row, col], np.array([r[2] for r in rows])[row]
    by = np.lexsort((text, key_2, key))
    row, col, key, key_2, text = row[by], col[by], key[by], key_2[by], text[by]
    new = np.append(True, (key[1:] != key[:-1]) | (key_2[1:] != key_2[:-1]))
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    last = np.append(first[1:], len(key)) - 1
    shared = (text[first] != text[last])[group]  # ordered by text within a window
    other = np.where(text == text[first][group], row[last][group], row[first][group])
    partner = np.full(there.shape, -1)
    partner[row[shared], col[shared]] = other[shared]
    step = np.diff(np.pad((partner >= 0).astype(np.int8), ((0, 0), (1, 1))), axis=1)
    matches = []
    for (i, a), b in zip(np.argwhere(step == 1).tolist(), np.argwhere(step == -1)[:, 1].tolist()):
        start = rows[i][3] - (WINDOW - 1)
        matches.append((rows[i][2], start + a, start + b - 1 + MIN_WORDS, rows[partner[i, a]][4]))
    at = np.flatnonzero(is_open[row])
    one = np.zeros(len(key), dtype=bool)
    one[at[np.unique(group[at], return_index=True)[1]]] = True
    told = is_open[row] & (~shared | one)
    start = np.array([r[3] for r in rows])[row] - (WINDOW - 1) + col
    outside = [(t, a, a + MIN_WORDS, rows[i][4], w, w_2) for t, a, i, w, w_2 in
               zip(text[told].tolist(), start[told].tolist(), row[told].tolist(), key.view(np.int64)[told].tolist(), key_2.view(np.int64)[told].tolist())]
    return matches, outside


def _compare(batches, run_rows: int):
    """Matches among the sorted rows of a task, and the windows of the runs it
    may hold in part: its first and last, and those cut at ``run_rows`` rows."""
    by_right, run, run_key, cut, n_runs = Neighbours(), [], None, False, 0
    held: list[list] = []
    held_open: list[bool] = []

    def close(open_run):
        if open_run or len(run) > NEAR + 1 or len({r[2] for r in run}) < len(run):  # in other runs all have met all
            held.extend(run)
            held_open.extend([open_run] * len(run))

    def batch(rows):
        for lo in range(0, len(rows), 20_000):
            some = rows[lo:lo + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), FOUND)], schema=FOUND)

    def flush():
        rows = [(*m, None, None) for m in by_right.matches]
        if held:
            matches, outside = _same_windows(held, np.array(held_open))
            rows += [(*m, None, None) for m in matches] + outside
        yield from batch(list(dict.fromkeys(rows)))
        by_right.matches = []
        held.clear()
        held_open.clear()

    for b in batches:
        for lo in range(0, b.num_rows, 2000):
            for raw in zip(*(c.to_pylist() for c in b.slice(lo, 2000).columns)):
                row = [raw[0].split(" "), raw[1].split(" ") if raw[1] else [], raw[2], raw[3], raw[4]]
                key = row[0][:SEED]
                if run and (key != run_key or len(run) >= run_rows):
                    goes_on = key == run_key
                    close(n_runs == 0 or cut or goes_on)
                    n_runs, cut = n_runs + (not goes_on), goes_on
                    run = []
                    if len(held) >= HELD:
                        yield from flush()
                run_key = key
                run.append(row)
                by_right.feed(row)
    close(True)
    yield from flush()


def _text_key(text: str):
    """The first 64 of the 128 bits that a text is known by."""
    return F.xxhash64(text)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and passage: doc_id, first_word, end_word (exclusive), n_words, other_id.

    A passage of at least MIN_WORDS words (white space apart, case kept) that
    also stands in another text, extended as far as it matches; overlapping and
    touching matches of a text are one passage; other_id is the smallest id of
    a document found to share part of it. A text of at least MIN_WORDS words
    that several rows have is a passage as a whole (other_id: the smallest id
    of the others). Repeats within one text alone don't count. Null texts are
    empty and have no passages; rows without an id take part, with null ids.
    Empty input: no rows.
    """
    rows = (only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .withColumn("text_key", _text_key("text")).withColumn("alt", F.xxhash64(F.lit(1), "text")))

    def seeds(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                keys, n_words, at, gram = [], [], [], []
                part = b.slice(lo, 500)
                for key, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = split_words(text)
                    p, g = minimisers(words)
                    keys.append(np.full(len(p), key, dtype=np.int64))
                    at.append(p)
                    gram.append(g)
                    n_words.append(len(words))
                size = [len(p) for p in at]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys + [np.empty(0, np.int64)])), pa.array(np.concatenate(at + [np.empty(0, np.int64)])),
                                                  pa.array(np.concatenate(gram + [np.empty(0, np.int64)])), *[pa.nulls(sum(size), pa.int64())] * 3],
                                                 names=["text_key", "pos", "seed", "doc_id", "n_words", "alt"])
                # beside the seeds one row per document: seed null
                yield pa.RecordBatch.from_arrays([part.column(1), pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.int64()), part.column(0), pa.array(n_words, pa.int64()), part.column(3)],
                                                 names=["text_key", "pos", "seed", "doc_id", "n_words", "alt"])

    seeded = lambda some: materialised(some.select("doc_id", "text_key", "text", "alt").mapInArrow(seeds, SEEDS_SQL), "passages-seeds", "zstd")
    pass1 = seeded(rows)
    # a text is known by 128 bits: those that share the first 64 only (about n^2 / 2^65 of n texts, so few that they are broadcast) get another key
    clash = (pass1.where("seed is null").groupBy("text_key").agg(F.min("alt").alias("lo"), F.max("alt").alias("hi")).where("lo <> hi").select("text_key"))
    clash = materialised(clash, "passages-clash")
    if not clash.isEmpty():
        again = rows.join(F.broadcast(clash), "text_key", "left_semi").withColumn("text_key", F.xxhash64(F.lit(2), "text"))
        rows = rows.join(F.broadcast(clash), "text_key", "left_anti").unionByName(again)
        pass1 = pass1.join(F.broadcast(clash), "text_key", "left_anti").unionByName(seeded(again))
    members = pass1.where("seed is null").select("doc_id", "text_key", "n_words")
    texts = members.groupBy("text_key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n"), F.min("n_words").alias("n_words"),
                                            F.min(F.struct("doc_id")).alias("rep"))
    kept = pass1.where("seed is not null").select("text_key", "pos", "seed")
    # written, so that both sides of the join are dealt for it and Spark can split a seed that a third of all texts hold
    shared = materialised(kept.groupBy("seed").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b")).where("a <> b").select("seed"), "passages-shared")
    places = kept.join(shared, "seed").groupBy("text_key").agg(F.collect_set("pos").alias("places"))
    wanted = places.join(texts.select("text_key", F.col("rep.doc_id").alias("rep_id")), "text_key").select(F.col("text_key").alias("p_key"), "rep_id", "places")
    chosen = (rows.join(wanted, (F.col("text_key") == F.col("p_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))
              .select("text_key", "doc_id", "text", "places"))

    def suffixes(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 100):
                out: list = [[], [], [], [], []]
                for key, doc, text, at in zip(*(c.to_pylist() for c in b.slice(lo, 100).columns)):
                    words = [w.decode("utf-8", "surrogatepass") for w in split_words(text)]
                    for p in sorted(at):
                        out[0].append(" ".join(words[p:p + MIN_WORDS]))
                        out[1].append(" ".join(words[max(0, p - WINDOW):p][::-1]))
                        out[2].append(key)
                        out[3].append(p)
                        out[4].append(doc)
                        if len(out[0]) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
                            out = [[], [], [], [], []]
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    names, types = ["right", "left", "text_key", "pos", "doc_id"], [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    suffix = materialised(chosen.mapInArrow(suffixes, "right string, left string, text_key long, pos long, doc_id long"), "passages-suffixes", "zstd")
    order = ["right", "left", "text_key", "pos"]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    compare = partial(_compare, run_rows=RUN)
    found = materialised(suffix.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(compare, FOUND_SQL), "passages-found", "zstd")
    matches = found.where("window is null").select("text_key", "first", "last", "other_id")
    # runs that lie in several tasks or parts meet by the hash of their windows
    told = found.where("window is not null").select("window", "window_2", "text_key", "first", "last", F.col("other_id").alias("doc_id"))
    place = F.struct("text_key", "doc_id")
    both = (told.groupBy("window", "window_2").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a.text_key <> b.text_key"))
    far = told.join(both, ["window", "window_2"]).select("text_key", "first", "last", F.when(F.col("text_key") == F.col("a.text_key"), F.col("b.doc_id")).otherwise(F.col("a.doc_id")).alias("other_id"))
    matches = matches.union(far)

    # overlapping and touching matches of a text become one passage (a text's matches are bounded by its length)
    by_start = Window.partitionBy("text_key").orderBy("first", "last", "other_id")
    reach = F.max("last").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    merged = (matches.distinct().withColumn("new", F.when(reach.isNull() | (F.col("first") > reach), 1).otherwise(0))
              .withColumn("island", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("text_key", "island").agg(F.min("first").alias("first_word"), F.max("last").alias("end_word"), F.min("other_id").alias("other_id")))
    copies = texts.where(f"n > 1 and n_words >= {MIN_WORDS}").select("text_key", "least", "most", F.col("n_words").alias("whole"))
    # a text with copies: the whole text instead of its parts
    in_parts = merged.join(copies, "text_key", "left_anti").join(members.select("doc_id", "text_key"), "text_key")
    in_whole = (copies.join(members.select("doc_id", "text_key"), "text_key")
                .select("doc_id", F.lit(0).cast("long").alias("first_word"), F.col("whole").alias("end_word"),
                        F.when(F.col("doc_id").eqNullSafe(F.col("least")), F.col("most")).otherwise(F.col("least")).alias("other_id")))
    out = in_parts.select("doc_id", "first_word", "end_word", "other_id").union(in_whole)
    return out.select("doc_id", "first_word", "end_word", (F.col("end_word") - F.col("first_word")).alias("n_words"), "other_id")
