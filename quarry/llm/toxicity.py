"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
Every window of a document is compressed with the ordinary dictionary and with
the toxic one (which stands in front of the ordinary content, so that lengths
differ only by what toxic text adds); the bytes saved are the window's gain.
Gains of at least a calibrated threshold count, and a logistic curve over their
sum, the largest gain and the number of windows gives the score.

Training reads a bounded sample of labelled rows (SAMPLE rows of each label,
chosen by a hash of the id, texts up to MAX_CHARS); scoring reads every window
of every whole text. Toxic samples are the stretches of toxic texts inside words,
stems and phrases that are more frequent among toxic texts than chance explains,
however common they are elsewhere, or all toxic text if there are none. Whole near
copies are left out of the sample first, so that a document that repeats doesn't
pass for a trait; phrases that different texts share stay.
Threshold and curve are fitted across two folds: each half of the sample is
measured with the dictionaries of the other half.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, only, text_or_empty

SAMPLE = 2000          # labelled rows of each label used for training, at most
MAX_CHARS = 20_000     # longer texts are not used for training
WINDOW, STRIDE = 48, 24  # bytes
LEVEL = 12
ORDINARY_BYTES, TOXIC_BYTES = 16 << 10, 2 << 10
STEM = 5               # shortest stem of a word that is looked at
PHRASE = 4             # longest phrase that is looked at, in words; longer ones are covered by their parts
EVIDENCE = 12.0        # twice the log likelihood ratio from which a frequency tells
NEAR_LEAST = 20        # three-word sequences from which a text can be a near copy
THRESHOLD = 0.3        # of the score, for predicted
CHUNK = STRIDE * 40_000  # bytes of a text cut into windows at once


def _words(text: str) -> list[bytes]:
    return re.findall(rb"[^\x00-\x26\x28-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.encode("utf-8", "surrogatepass").lower())


def _distinct(texts: list[str]) -> list[list[bytes]]:
    """Words of each text that isn't a near copy: that has at most half of its
    three-word sequences in common with any one earlier text. Texts of fewer than
    NEAR_LEAST such sequences are all kept: there the repeated phrase is the text."""
    at, out = {}, []
    for t in texts:
        words = _words(t)
        grams = {hash(tuple(words[i:i + 3])) for i in range(len(words) - 2)}
        if len(grams) >= NEAR_LEAST:
            shared = Counter(j for g in grams for j in at.get(g, ()))
            if shared and 2 * max(shared.values()) > len(grams):
                continue
        for g in grams:
            at.setdefault(g, []).append(len(out))
        out.append(words)
    return out


def _stems(word: bytes) -> set[bytes]:
    return {word, *(word[:k] for k in range(STEM, len(word)))}


def _phrases(row: list[bytes], n: int, common: set) -> list[tuple[int, tuple]]:
    """(position, words) of the phrases of n words whose parts of n - 1 words are common."""
    part = (lambda i: tuple(row[i:i + n - 1])) if n > 2 else (lambda i: row[i])
    return [(i, tuple(row[i:i + n])) for i in range(len(row) - n + 1) if part(i) in common and part(i + 1) in common]


def _telling(bad: list[list[bytes]], good: list[list[bytes]]) -> set:
    """Words, stems and phrases of up to PHRASE words that so many more toxic than
    ordinary texts have that chance doesn't explain it (likelihood ratio over EVIDENCE)."""
    n_bad, n_good = max(1, len(bad)), max(1, len(good))

    def tells(a: int, b: int) -> bool:
        p = (a + b) / (n_bad + n_good)
        return a / n_bad > b / n_good and 2 * (a * math.log(a / (n_bad * p)) + (b * math.log(b / (n_good * p)) if b else 0)) > EVIDENCE

    marks, common = set(), set()
    for n in range(1, PHRASE + 1):
        units = (lambda row: {s for w in set(row) for s in _stems(w)}) if n == 1 else (lambda row: {g for _, g in _phrases(row, n, common)})  # noqa: B023
        in_bad, in_good = Counter(), Counter()
        for row in bad:
            in_bad.update(units(row))
        often = {u for u, a in in_bad.items() if a >= 3}  # no rarer part makes a phrase as frequent
        for row in good:
            in_good.update(units(row) & often)
        marks |= {u for u in often if tells(in_bad[u], in_good[u])}
        common = often
    return marks


def _stretches(row: list[bytes], marks: set) -> list[bytes]:
    """The longest stretches of a text that lie inside telling words and phrases."""
    on = [not marks.isdisjoint(_stems(w)) for w in row]
    for n in range(2, PHRASE + 1):
        for i in range(len(row) - n + 1):
            if tuple(row[i:i + n]) in marks:
                on[i:i + n] = [True] * n
    out = []
    for i, w in enumerate(row):
        if on[i]:
            if i and on[i - 1]:
                out[-1] += b" " + w
            else:
                out.append(b" " + w)
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; samples too few for zstandard's trainer are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and of the toxic dictionary. Where nothing tells, the toxic one is trained on all toxic text."""
    bad, good = _distinct(toxic), _distinct(ordinary)
    lines = lambda rows: [b" ".join(row[i:i + 12]) for row in rows for i in range(0, len(row), 12)]
    thinned = lambda samples: samples[::max(1, len(samples) // 20_000)]
    marks = _telling(bad, good)
    said = [s for row in bad for s in _stretches(row, marks)]
    plain, samples = thinned(lines(good)), [b"".join(said[i:i + 4]) for i in range(0, len(said), 4)] or thinned(lines(bad))
    return _dictionary(plain, ORDINARY_BYTES) if plain else b"", _dictionary(samples, TOXIC_BYTES) if samples else b""


class Gains:
    """Bytes that the toxic dictionary saves in each window of a text."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.none = not toxic
        self.coders = []
        for content in (ordinary, toxic + ordinary):
            d = zstandard.ZstdCompressionDict(content or b"........", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def of(self, text: str) -> np.ndarray:
        """Windows cover the whole text, its last bytes too; a text without bytes has none."""
        data = text.encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
        if not data or self.none:
            return np.zeros(0, dtype=np.int64)
        out = []
        for lo in range(0, max(1, len(data) - (WINDOW - STRIDE)), CHUNK):
            part = data[lo:lo + CHUNK + WINDOW - STRIDE]
            start = np.arange(0, max(1, len(part) - (WINDOW - STRIDE)), STRIDE, dtype=np.uint64)
            length = np.minimum(np.uint64(WINDOW), np.uint64(len(part)) - start)
            windows = zstandard.BufferWithSegments(part, np.stack([start, length], axis=1).tobytes())
            a, b = (np.fromiter(map(len, c.multi_compress_to_buffer(windows, threads=0)), dtype=np.int64, count=len(start)) for c in self.coders)
            out.append(a - b)
        return np.concatenate(out)


@dataclass
class Model:
    """Dictionaries, window threshold and logistic curve; without dictionaries the score is one low rate."""

    ordinary: bytes
    toxic: bytes
    least_gain: int
    weights: tuple[float, ...]

    def features(self, gains: np.ndarray, least: int | None = None) -> list[float]:
        least = self.least_gain if least is None else least
        return [1.0, math.log1p(float(gains[gains >= least].sum())), math.log1p(max(0.0, float(gains.max(initial=0)))), math.log1p(len(gains))]

    def score(self, gains: np.ndarray) -> float:
        z = sum(w * f for w, f in zip(self.weights, self.features(gains)))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(toxic: list[str], ordinary: list[str], base_rate: float | None = None) -> Model:
    """A model from texts of both labels; ``base_rate`` is the share of toxic rows outside the sample."""
    n = len(toxic) + len(ordinary)
    rate = base_rate if base_rate is not None else (len(toxic) / n if n else 0.0)
    low = max(1e-6, min(rate, 0.9 * THRESHOLD))  # too little to learn from: nothing is called toxic
    flat = Model(b"", b"", 1, (math.log(low / (1 - low)), 0.0, 0.0, 0.0))
    if len(toxic) < 4 or len(ordinary) < 4:
        return flat
    measured = []
    for k in (0, 1):
        g = Gains(*train_dictionaries(toxic[k::2], ordinary[k::2]))
        measured += [(g.of(t), 1) for t in toxic[1 - k::2]] + [(g.of(t), 0) for t in ordinary[1 - k::2]]
    y = np.array([label for _, label in measured], dtype=float)
    weight = np.where(y == 1, rate * len(y) / y.sum(), (1 - rate) * len(y) / (len(y) - y.sum()))
    best = None
    for least in range(2, 12):
        model = Model(b"", b"", least, ())
        x = np.array([model.features(v) for v, _ in measured])
        w = _logistic(x, y, weight)
        z = x @ w
        loss = float((weight * (np.logaddexp(0, z) - y * z)).sum())
        if best is None or loss < best[0]:
            best = (loss, least, w)
    ordinary_part, toxic_part = train_dictionaries(toxic, ordinary)
    return Model(ordinary_part, toxic_part, best[1], tuple(best[2].tolist())) if toxic_part else flat


def training_sample(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str,
                    per_label: int = SAMPLE) -> tuple[list[str], list[str], float]:
    """Texts of up to ``per_label`` rows of each label, and the share of label 1
    among the labelled ids. An id is toxic if any of its label rows says so."""
    known = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .where("id is not null and label in (0, 1)").where(learn).groupBy("id").agg(F.max("label").alias("label")))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    chosen = [known.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(per_label) for k in (1, 0)]
    rows = (only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))
            .where(F.length("text").between(1, MAX_CHARS))
            # at most 2 * per_label ids
            .join(F.broadcast(chosen[0].unionAll(chosen[1])), "id").orderBy(F.xxhash64("id"), "id", "text").limit(2 * per_label).collect())
    by = {k: [r.text for r in rows if r.label == k] for k in (0, 1)}
    return by[1], by[0], counts.toxic / counts.n if counts.n else 0.0


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             held_out_mod: int = 4, held_out_rest: int = 2) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 from THRESHOLD on).

    Rows whose crc32(id as text) leaves ``held_out_rest`` modulo ``held_out_mod``
    are never learnt from. A null text is the empty text and scored as one.
    With fewer than four sampled rows of either label every score is the base
    rate, kept below THRESHOLD. The sample and the model (a few ten kB) are all that passes the
    driver; scoring needs no shuffle. Empty input: no rows.
    """
    learn = crc_mod(F.col("id"), held_out_mod) != held_out_rest
    model = fit(*training_sample(docs, labels, learn, id_col, text_col, label_col))
    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        gains = Gains(model.ordinary, model.toxic)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                scores = [model.score(gains.of(t)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), held_out_mod) == held_out_rest).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The input's rows that are not predicted toxic, with all their columns.
    The score is computed beside each row, so nothing is joined or shuffled."""
    learn = crc_mod(F.col("id"), 4) != 2
    model = fit(*training_sample(docs, labels, learn, id_col, text_col, label_col))
    text_at = docs.columns.index(text_col)

    def clean(batches):
        gains = Gains(model.ordinary, model.toxic)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                keep = [model.score(gains.of(t or "")) < THRESHOLD for t in part.column(text_at).to_pylist()]
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
