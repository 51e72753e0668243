"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the
piece they form, then by position; the best pair is merged and its new
neighbours enter the agenda. No piece of the vocabulary holds a space mark
behind another character, nor a character such as a line break, so merges
never cross these places and the text falls into independent units. Units are
encoded once per slice of text, in two forms of the same agenda: a matrix of
pair scores for many short units of one length at once, and a heap for a long
unit. Unit results are kept in a cache per Python worker, bounded in units and in characters.

Every unit is checked against the sentencepiece library where it enters the
cache (``verify``); a difference fails the job.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, slices, text_or_empty
from .lookup import PairTable

MARK = "▁"  # fixed value: the library's space mark
NO_RANK = np.iinfo(np.int32).max
SHORT = 48
CACHE_UNITS = 250_000
CACHE_CHARS = 32_000_000  # of the cached units, their ids and their decoded text; the units of one slice come on top


class Vocabulary:
    """Pieces, scores and the pairs that merge, read from a model file.

    Symbols are piece ids; a character that is no piece is ``size`` plus its code point."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        every = range(self.size)
        self.pieces = [sp.id_to_piece(i) for i in every]
        self.bytes_of = {i: int(self.pieces[i][3:5], 16) for i in every if sp.is_byte(i)}
        self.byte_id = {b: i for i, b in self.bytes_of.items()}
        normal = {self.pieces[i]: i for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.normal = normal
        scores = sorted({sp.get_score(i) for i in normal.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        self.rank = {i: rank_of[sp.get_score(i)] for i in normal.values()}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in normal):
            raise ValueError("a piece holds a space mark behind another character")
        self.symbol = lambda c: normal.get(c, self.size + ord(c))
        self.pairs: dict[tuple[int, int], int] = {}
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                a, b = piece[:k], piece[k:]
                if (a in normal or k == 1) and (b in normal or len(b) == 1):
                    self.pairs[normal[a] if a in normal else self.symbol(a), normal[b] if b in normal else self.symbol(b)] = i
        merging = {c for p in normal if len(p) > 1 for c in p}
        #: characters that can't merge and are frequent in plain text stand alone
        self.alone = "".join(c for c in "\n\t\r|" if c not in merging)
        self.units = re.compile(f"[{re.escape(self.alone)}]|{MARK}+[^{MARK}{re.escape(self.alone)}]*|[^{MARK}{re.escape(self.alone)}]+" if self.alone
                                else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        first, second, merged = (np.array(x, dtype=np.int64) for x in zip(*((a, b, m) for (a, b), m in self.pairs.items())))
        self.table = PairTable(first, second, merged)
        self.rank_array = np.full(self.size + 1, NO_RANK, dtype=np.int32)
        for i, r in self.rank.items():
            self.rank_array[i] = r
        self.char_symbol = np.arange(0x110000, dtype=np.int64) + self.size
        for p, i in normal.items():
            if len(p) == 1:
                self.char_symbol[ord(p)] = i
        self.text_of = [p.replace(MARK, " ") for p in self.pieces]
        self.decimal = [str(i) for i in every]
        self.byte_ids = frozenset(self.bytes_of)

    def split(self, text: str) -> list[str]:
        """The independent units of a text, after the library's own preparation (identity with a space mark in front)."""
        return self.units.findall(MARK + text.replace(" ", MARK)) if text else []

    def ids(self, symbols: list[int]) -> list[int]:
        """Symbols as piece ids; a character outside the vocabulary becomes its UTF-8 bytes."""
        out = []
        for s in symbols:
            if s < self.size:
                out.append(s)
            else:
                out += [self.byte_id[b] for b in chr(s - self.size).encode("utf-8", "surrogatepass")]
        return out

    def agenda(self, unit: str) -> list[int]:
        """Symbols of one unit by a heap of (rank, position); stale entries are skipped when they come up."""
        sym = [self.symbol(c) for c in unit]
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = right[i] if i >= 0 else -1
            if j >= 0 and (m := self.pairs.get((sym[i], sym[j]))) is not None:
                heapq.heappush(heap, (self.rank[m], i, sym[i], sym[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], right[i] = self.pairs[a, b], -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            push(left[i])
            push(i)
        return [s for s in sym if s >= 0]

    def agenda_matrix(self, units: list[str]) -> list[list[int]]:
        """Symbols of many units of one length: a row of pair ranks is the agenda of a unit."""
        length = len(units[0])
        code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(units), length)
        sym = self.char_symbol[code]
        out: list = [None] * len(units)
        who = np.arange(len(units))
        if length > 1:
            made = self.table.get(sym[:, :-1], sym[:, 1:])
            rank = self.rank_array[made]
            while len(who) and length > 1:
                best = rank.argmin(axis=1)
                rows = np.arange(len(who))
                over = rank[rows, best] == NO_RANK
                if over.any():
                    for i, s in zip(who[over].tolist(), sym[over].tolist()):
                        out[i] = s
                    go = ~over
                    who, sym, made, rank, best = who[go], sym[go], made[go], rank[go], best[go]
                    if not len(who):
                        break
                    rows = np.arange(len(who))
                # merge at best: what stands behind moves one place left
                keep = np.arange(length - 1)[None, :]
                sym[rows, best] = made[rows, best]
                sym = np.take_along_axis(sym, keep + (keep > best[:, None]), axis=1)
                length -= 1
                if length == 1:
                    break
                keep = keep[:, :-1]
                move = keep + (keep >= best[:, None])  # the merged pair leaves; its neighbours are ranked anew
                made, rank = np.take_along_axis(made, move, axis=1), np.take_along_axis(rank, move, axis=1)
                for at in (best - 1, best):
                    r = np.flatnonzero((at >= 0) & (at < length - 1))
                    if len(r):
                        p = at[r]
                        made[r, p] = m = self.table.get(sym[r, p], sym[r, p + 1])
                        rank[r, p] = self.rank_array[m]
        for i, s in zip(who.tolist(), sym.tolist()):
            out[i] = s[:length]
        return out

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Piece ids of each unit."""
        out: list = [None] * len(units)
        by_length: dict[int, list[int]] = {}
        for i, u in enumerate(units):
            if len(u) > SHORT:
                out[i] = self.ids(self.agenda(u))
            else:
                by_length.setdefault(len(u), []).append(i)
        for at in by_length.values():
            for i, s in zip(at, self.agenda_matrix([units[i] for i in at])):
                out[i] = s if max(s) < self.size else self.ids(s)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_units(self.split(text)) for i in ids]

    def unit_text(self, ids: list[int]) -> str:
        """Pieces as text, byte pieces read as UTF-8 (each byte that doesn't fit becomes U+FFFD)."""
        if self.byte_ids.isdisjoint(ids):
            return "".join([self.text_of[i] for i in ids])
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if i >= 0:
                out.append(self.text_of[i])
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids as the library gives it: without the space mark put in front."""
        out = self.unit_text(ids)
        return out[1:] if ids and self.text_of[ids[0]].startswith(" ") else out

    def check(self, units: list[str], got: list[list[int]]) -> None:
        """Fails if the library encodes a unit differently."""
        plain = [u[1:] if u[0] == MARK else "\n" + u for u in units]
        for u, p, mine, theirs in zip(units, plain, got, self.library.encode(plain, num_threads=1)):
            if u == MARK:
                continue  # only the mark in front: the library adds it to non-empty texts alone
            if mine != (theirs if u[0] == MARK else theirs[2:]):
                raise ValueError(f"unit {u!r}: {mine}, the library gives {theirs}")


def _utf8(data: bytes) -> str:
    out = []
    while data:
        try:
            return "".join(out) + data.decode("utf-8")
        except UnicodeDecodeError as e:
            out.append(data[:e.start].decode("utf-8") + "�")
            data = data[e.start + 1:]
    return "".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Units(dict):
    """Number of ids, ids as text and decoded text by unit, and the characters that units and results hold."""

    chars = 0

    def put(self, unit: str, n: int, written: str, text: str) -> None:
        self[unit] = (n, written, text)
        self.chars += len(unit) + len(written) + len(text)

    def keep(self, units: set[str]) -> None:
        """Only these units stay: those of the slice at hand, so that frequent ones are not encoded anew."""
        kept = [(u, *self[u]) for u in units if u in self]
        self.clear()
        for k in kept:
            self.put(*k)

    def clear(self) -> None:
        super().clear()
        self.chars = 0


_UNITS: dict[str, Units] = {}


def _encoded(voc: Vocabulary, path: str, texts: list[str], verify: bool) -> list[tuple[int, str, str]]:
    """Number of ids, ids as text, decoded text of each text; new units enter the cache together."""
    cache = _UNITS.setdefault(path, Units())
    split = [voc.split(t) for t in texts]
    seen = set().union(*split)
    new = [u for u in seen if u not in cache]
    if len(cache) + len(new) > CACHE_UNITS or cache.chars > CACHE_CHARS:
        cache.keep(seen)
    ids = voc.encode_units(new)
    if verify:
        voc.check(new, ids)
    decimal = voc.decimal
    for u, i in zip(new, ids):
        cache.put(u, len(i), ",".join([decimal[k] for k in i]), voc.unit_text(i))
    out = []
    for units in split:
        if not units:
            out.append((0, "", ""))
            continue
        found = [cache[u] for u in units]
        whole = "".join([t for _, _, t in found])
        out.append((sum([n for n, _, _ in found]), ",".join([w for _, w, _ in found]), whole[1:] if whole[0] == " " else whole))
    return out


OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the text decoded from the ids) of every row.

    A null text is the empty text: no ids. No shuffle; memory is bounded by the
    longest text and the unit cache. Empty input: no rows.
    """
    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        voc = vocabulary(path)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for b in batches:
            texts, out = b.column(1).to_pylist(), []
            for lo, hi in slices(texts):
                out += [(n, sha(i), sha(t)) for n, i, t in _encoded(voc, path, texts[lo:hi], verify)]
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, f.type) for c, f in zip(zip(*out), list(OUT)[1:])]], schema=OUT)

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids themselves."""
    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        voc = vocabulary(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in slices(texts):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([voc.encode(t) for t in texts[lo:hi]], pa.list_(pa.int32()))],
                                                 names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(frame: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of its ids (null ids: the empty text)."""
    rows = only(frame, id_col, ids_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids"))

    def run(batches):
        voc = vocabulary(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([voc.decode(i or []) for i in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, "doc_id long, text string")
