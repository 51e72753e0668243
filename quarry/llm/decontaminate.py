"""Benchmark decontamination by winnowing.

Words: A-Z lower-cased, stretches of letters, digits and all non-ASCII. A
document word is hit if it lies in an occurrence of a window of SPAN
consecutive item words (items of fewer words: one window of them all).

1. Winnowing, the same on both sides: every GRAM-word hash gets a value; of
   each SPAN - GRAM + 1 consecutive grams (they fill SPAN words) the smallest
   value is the fingerprint. Whatever SPAN words two texts share, they share
   its fingerprint: the guarantee holds for every window. A window of fewer
   than SPAN words is its own only gram.
2. Item windows are written once. Their fingerprints also fill a bit array of
   fixed size (``filter_bits``, at most 2^27 bits, 16 MB): documents leave out
   windows whose fingerprint is in no item, so that next to nothing is
   shuffled; a fuller array only lets more rows through.
3. Fingerprints of documents and items are joined. Hits are extended to the
   whole windows around them, which are compared by 128 bits (two hashes of
   independent seeds); neighbouring windows chain to spans of any length.
4. Words hit: the union of the windows of a text, by a window function. Items:
   windows of equal item sets form a class, texts of equal class sets a set;
   the item list is made once per set, so copies and passages that many
   documents or many items share cost one list, not one per pair.

Documents are scanned once. Rows of equal text (two 64-bit hashes) are
answered once and joined back: groups of copies do not multiply the work.

Null texts have no words, null item ids are written as the empty text, items
without words match nothing, rows under one item_id are one item with the
windows of all, repeated documents are answered each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .common import materialised, text_or_empty

SPAN, GRAM = 10, 5
FILTER_BITS = 1 << 27   # most bits of the array that every task holds
BITS_PER_WINDOW = 32
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # fixed values: odd factors of the two word-window hashes


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (fixed values: the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows_of(cut: words.Words, sizes: list[int], span: int = SPAN, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, start, fingerprint, hash 1, hash 2) of all windows of the given sizes (at most ``span``) that lie in one text."""
    n = len(cut.ids)
    spelt = cut.vocabulary.to_pylist()
    value = [np.array([xxhash.xxh64_intdigest(w, seed) for w in spelt] or [0], np.uint64)[cut.ids] for seed in (1, 2)]
    left = np.repeat(cut.bounds[1:], np.diff(cut.bounds)) - np.arange(n)  # words to the end of the text
    total = [np.zeros(n, np.uint64) for _ in value]
    grams = None
    factor = [1, 1]
    for size in range(1, min(span, n) + 1):
        for f, v in enumerate(value):
            total[f] = total[f][:n - size + 1] + v[size - 1:] * np.uint64(factor[f])
            factor[f] = factor[f] * _BASES[f] % 2 ** 64
        if size == gram:
            grams = _mixed(total[0])
        if size in sizes:
            start = np.flatnonzero(left[:n - size + 1] >= size)
            if size < span:
                mark = _mixed(total[0] ^ np.uint64(size))
            else:
                mark, reach = grams, 1  # the smallest gram of each window, by doubling
                while reach < span - gram + 1:
                    step = min(reach, span - gram + 1 - reach)
                    mark, reach = np.minimum(mark[:-step], mark[step:]), reach + step
            yield size, start, mark[start], total[0][start], total[1][start]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def item_windows(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(item, size, fp, w1, w2): the distinct windows of every item."""
    rows = items.select(F.coalesce(F.col("`item_id`").cast("string"), F.lit("")).alias("item"), text_or_empty().alias("text"))

    def run(batches):
        for b in batches:
            for i, j in words.slices(b.column(1)):
                cut = words.cut(b.column(1).slice(i, j - i), words.LOWER_OR_DIGIT, fold=True)
                count = np.diff(cut.bounds)
                for size, start, fp, w1, w2 in windows_of(cut, list(range(1, span + 1)), span, gram):
                    item = np.searchsorted(cut.bounds, start, side="right") - 1
                    ok = (size == span) | (count[item] == size)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(i + item[ok])), pa.array(np.full(int(ok.sum()), size, np.int32)), *(pa.array(_signed(x[ok])) for x in (fp, w1, w2))],
                        names=["item", "size", "fp", "w1", "w2"])

    return rows.mapInArrow(run, "item string, size int, fp long, w1 long, w2 long").distinct()


def fingerprint_filter(windows: DataFrame, most: int = FILTER_BITS) -> tuple[list[int], np.ndarray]:
    """The window sizes that occur and the bit array of the fingerprints (at most ``most`` bits whatever the items)."""
    size = windows.agg(F.collect_set("size").alias("sizes"), F.count(F.lit(1)).alias("n")).first()
    bits = 1 << 16
    while bits < min(most, BITS_PER_WINDOW * size["n"]):
        bits *= 2
    slot = F.col("fp").bitwiseAND(F.lit(bits - 1))
    cells = (windows.select(F.shiftright(slot, 6).alias("cell"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow())  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.uint64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return sorted(size["sizes"]), out


def _passes(fp: np.ndarray, cells: np.ndarray) -> np.ndarray:
    slot = fp & np.uint64(64 * len(cells) - 1)
    return (cells[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


_HIT = [("start", pa.int64()), ("size", pa.int32()), ("fp", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64())]


def marked(docs: DataFrame, sizes: list[int], cells: np.ndarray, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, t1, t2, n_words, hits): per row its text's key, and the windows whose fingerprint passes the filter."""
    rows = docs.select(F.col("`doc_id`").alias("doc_id"), F.xxhash64(text_or_empty()).alias("t1"),
                       F.xxhash64(F.lit(1), text_or_empty()).alias("t2"), text_or_empty().alias("text"))

    def run(batches):
        for b in batches:
            for i, j in words.slices(b.column(3)):
                cut = words.cut(b.column(3).slice(i, j - i), words.LOWER_OR_DIGIT, fold=True)
                found = [(np.zeros(0, np.int64), *(np.zeros(0, np.uint64),) * 3, np.zeros(0, np.int32))]
                for size, start, fp, w1, w2 in windows_of(cut, sizes, span, gram):
                    ok = _passes(fp, cells)
                    found.append((start[ok], fp[ok], w1[ok], w2[ok], np.full(int(ok.sum()), size, np.int32)))
                start, fp, w1, w2, size = (np.concatenate(x) for x in zip(*found))
                by = np.argsort(start, kind="stable")
                start, size = start[by], size[by]
                doc = np.searchsorted(cut.bounds, start, side="right") - 1
                ends = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                hit = pa.StructArray.from_arrays([pa.array(start - cut.bounds[doc]), pa.array(size), *(pa.array(_signed(x[by])) for x in (fp, w1, w2))],
                                                 fields=[pa.field(f, t) for f, t in _HIT])
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in range(3)), pa.array(np.diff(cut.bounds)), pa.ListArray.from_arrays(pa.array(ends), hit)],
                                                 names=["doc_id", "t1", "t2", "n_words", "hits"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, t1 long, t2 long, n_words long, hits array<struct<start:long,size:int,fp:long,w1:long,w2:long>>")


def _set_of(*cols: str):
    """Columns that name a set of rows whatever their order: their number and two exclusive sums of independent hashes."""
    return (F.count(F.lit(1)).alias("sn"), F.bit_xor(F.xxhash64(*cols)).alias("s1"), F.bit_xor(F.xxhash64(F.lit(1), *cols)).alias("s2"))


def occurrences(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """(t1, t2, start, size, w1, w2): the item windows that occur in each distinct text of ``marked`` rows."""
    hits = rows.where(F.size("hits") > 0).select("t1", "t2", F.inline("hits")).dropDuplicates(["t1", "t2", "start", "size"])
    shared = hits.join(windows.select("fp").distinct(), "fp", "left_semi")
    return shared.join(windows.select("size", "w1", "w2").distinct(), ["size", "w1", "w2"]).select("t1", "t2", "start", "size", "w1", "w2")


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Per row of (doc_id, text): words, words hit, items found and the digest
    of their ids (sorted as strings, comma-joined). ``items``: (item_id, text)."""
    windows = materialised(item_windows(items, span, gram), "decontaminate-items")
    sizes, cells = fingerprint_filter(windows, filter_bits)
    rows = materialised(marked(docs, sizes, cells, span, gram), "decontaminate-docs")
    found = materialised(occurrences(rows, windows), "decontaminate-found")

    before = Window.partitionBy("t1", "t2").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    words_hit = found.select("t1", "t2", fresh.alias("fresh")).groupBy("t1", "t2").agg(F.sum("fresh").alias("n_hit"))

    # windows with the same items are one class, texts with the same classes one set
    key = ["size", "w1", "w2"]
    classes = windows.groupBy(*key).agg(*_set_of("item")).select(*key, F.struct("sn", "s1", "s2").alias("class"))
    of_text = found.select("t1", "t2", *key).join(classes, key).select("t1", "t2", "class").distinct()
    sets = of_text.groupBy("t1", "t2").agg(*_set_of("class")).select("t1", "t2", F.struct("sn", "s1", "s2").alias("set"))
    one_text = sets.groupBy("set").agg(F.min(F.struct("t1", "t2")).alias("t")).select("set", "t.t1", "t.t2")
    one_window = classes.groupBy("class").agg(F.min(F.struct(*key)).alias("w")).select("class", "w.*")
    items_of = windows.join(one_window, key).select("class", "item")
    lists = (of_text.join(one_text, ["t1", "t2"]).join(items_of, "class").select("set", "item").distinct()
             .groupBy("set").agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256")))

    answer = words_hit.join(sets, ["t1", "t2"]).join(lists, "set").select("t1", "t2", "n_hit", "n_items", "items_sha256")
    return rows.select("doc_id", "t1", "t2", "n_words").join(answer, ["t1", "t2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def shared_spans(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, start, length): the maximal stretches of hit words, in word numbers, per row of docs."""
    windows = materialised(item_windows(items, span, gram), "decontaminate-items")
    sizes, cells = fingerprint_filter(windows, filter_bits)
    rows = materialised(marked(docs, sizes, cells, span, gram), "decontaminate-docs")
    found = occurrences(rows, windows).select("t1", "t2", "start", (F.col("start") + F.col("size")).alias("end"))
    order = Window.partitionBy("t1", "t2").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("t1", "t2", "run").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    return rows.select("doc_id", "t1", "t2").join(spans, ["t1", "t2"]).select("doc_id", "start", "length")
