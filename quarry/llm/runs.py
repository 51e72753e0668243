"""Periodic runs by grammar compression (Re-Pair).

A run is a stretch of consecutive words with smallest period q and length of
at least max(6, 4 q) that cannot be extended. Per document:

1. Re-Pair: the most frequent pair of neighbouring symbols becomes a new
   nonterminal until no pair repeats. Pairs that do not overlap a more
   frequent one are replaced in the same round, for all documents of a slice
   at once; ties go to a fixed scramble of the pairs, so that equal
   neighbours merge evenly and the grammar stays shallow.
2. Each nonterminal X -> A B is looked at once, in its first derivation: the
   runs inside X that cross the boundary between A and B. The symbols left at
   the end are the axiom; each boundary between two of them is looked at in
   the whole document. (The run's lowest ancestor in the derivation tree
   holds it whole and has it on its boundary.)
3. The runs of a nonterminal are carried to all positions where it is derived.
4. Intervals of equal period that overlap by a period or more are merged:
   what a nonterminal sees of a run that goes on beyond it falls to the whole.

Runs on a boundary: for a period q of (g, 2g], g a power of two, a run over
the boundary holds at one of eight anchors m, m - g, .. m - 7g a block of 2g
words that recurs q words later and not before. Block identities come from
doubling (pairs of identities of half the length, exact, no hashing); blocks
that occur once drop out at once, so ordinary text costs little. The same
identities give the extensions to both sides.

Work per document is O(n log n) in numpy; documents never meet, so nothing is
shuffled. A task holds one slice of texts (``words.SLICE_BYTES``) or one longer text.

Null and empty texts have no words. A null id counts as the empty text in the
contract's crc32. Rows repeated, or under one id, are answered each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import text_or_empty

EXPONENT, LEAST = 4, 6  # the contract's run: length >= max(LEAST, EXPONENT * period)


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the keys, equal keys as they stood; dense rank of each key in that order; size of each rank)."""
    order = np.argsort(keys, kind="stable")
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.cumsum(fresh) - 1
    return order, rank, np.bincount(rank, minlength=0)


class Grammar:
    """Re-Pair over the documents of a slice. ``symbols`` hold a document's own
    terminals (no symbol occurs in two documents), ``stop[i]`` the end of the document of word i."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray):
        n = len(symbols)
        self.stop = np.repeat(bounds[1:], np.diff(bounds))
        sym, after = symbols.copy(), np.arange(1, n + 1)
        before = np.arange(-1, n)
        before[bounds[:-1][np.diff(bounds) > 0]] = n  # no symbol before: the free cell at the end
        dead, weight = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=np.int64)
        used = int(sym.max()) + 1 if n else 0
        rules, starts, middles, ends = [], [], [], []
        live = np.flatnonzero(after < self.stop)
        while len(live):
            order, rank, sizes = _ranked((sym[live] << 32) | sym[after[live]])
            pair = np.empty(len(live), np.int64)
            pair[order] = rank
            often = sizes[pair] >= 2
            live, pair = live[often], pair[often]
            if not len(live):
                break
            own = (sizes[pair] << 32) | ((pair * 2654435761) & 0xFFFFFFFF)  # count, then a fixed scramble of the pair (odd factor: one to one)
            weight[live] = own
            left, right = weight[before[live]], weight[after[live]]
            at = np.arange(len(live))
            first = np.maximum.accumulate(np.where(left == own, 0, at))  # x x x x: every other pair
            chosen = (left <= own) & (right <= own) & ((at - first) % 2 == 0)
            weight[live] = 0
            i = live[chosen]
            j = after[i]
            end = after[j]
            _, name = np.unique(pair[chosen], return_inverse=True)
            rules.append(used + name), starts.append(i), middles.append(j), ends.append(end)
            sym[i] = used + name
            used += int(name.max()) + 1
            after[i], dead[j] = end, True
            inside = end < self.stop[i]
            before[end[inside]] = i[inside]
            touched = before[i]
            rest = live[~chosen]
            live = np.unique(np.concatenate([rest[~dead[rest]], i, touched[touched < n]]))
            live = live[after[live] < self.stop[live]]
        none = np.zeros(0, np.int64)
        rule, start, middle, end = (np.concatenate(x) if x else none for x in (rules, starts, middles, ends))
        by_rule = np.argsort(rule, kind="stable")  # starts ascend within a rule
        rule, self.start, middle, end = rule[by_rule], start[by_rule], middle[by_rule], end[by_rule]
        self.first = np.flatnonzero(np.r_[True, rule[1:] != rule[:-1]]) if len(rule) else none  # first derivation of each nonterminal
        self.times = np.diff(np.r_[self.first, len(rule)])
        # for each word m: the stretch in which the boundary before m is looked at, and whose it is (-1: the axiom's)
        self.low, self.high, self.owner = np.full(n, -1), np.full(n, -1), np.full(n, -1)
        self.low[middle[self.first]] = self.start[self.first]
        self.high[middle[self.first]] = end[self.first]
        self.owner[middle[self.first]] = np.arange(len(self.first))
        axiom = np.flatnonzero(~dead[:n])
        begin = np.repeat(bounds[:-1], np.diff(bounds))
        axiom = axiom[axiom > begin[axiom]]
        self.low[axiom], self.high[axiom] = begin[axiom], self.stop[axiom]

    def derived(self, owner: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """The places found in a nonterminal's first derivation, at all its derivations (and which found place each came from)."""
        times = np.where(owner >= 0, self.times[owner] if len(self.times) else 0, 1)
        which = np.repeat(np.arange(len(owner)), times)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        of = owner[which]
        first = self.first[of] if len(self.first) else np.zeros(len(of), np.int64)
        shift = np.where(of >= 0, self.start[first + nth] - self.start[first], 0) if len(self.start) else np.zeros(len(of), np.int64)
        return [which, *(p[which] + shift for p in places)]


class Blocks:
    """Identities of the blocks of 2^k words that occur more than once in their document."""

    def __init__(self, symbols: np.ndarray, stop: np.ndarray):
        self.n, self.levels, self.near = len(symbols), [], []
        at, keys, size = np.arange(self.n), symbols, 1
        while len(at):
            order, rank, sizes = _ranked(keys)
            often = sizes[rank] >= 2
            order, rank = order[often], rank[often]
            if not len(order):
                break
            here = at[order]
            gap = np.zeros(len(here), np.int64)  # to the next occurrence
            gap[:-1] = np.where(rank[1:] == rank[:-1], here[1:] - here[:-1], 0)
            close = (gap == 1) if size == 1 else (gap > size // 2) & (gap <= size)
            self.near.append((here[close], gap[close]))
            self.levels.append(self._level(here, rank))
            here = np.sort(here)
            here = here[here + 2 * size <= stop[here]]
            one = self.get(len(self.levels) - 1, here)
            two = self.get(len(self.levels) - 1, here + size)
            at, keys, size = here[two >= 0], ((one << 32) | two)[two >= 0], 2 * size

    def _level(self, here, ident):
        if 8 * len(here) >= self.n:
            dense = np.full(self.n, -1, np.int32)
            dense[here] = ident
            return dense
        by = np.argsort(here)
        return here[by], ident[by]

    def get(self, k: int, at: np.ndarray) -> np.ndarray:
        level = self.levels[k]
        if isinstance(level, np.ndarray):
            return level[at].astype(np.int64)
        here, ident = level
        i = np.minimum(np.searchsorted(here, at), len(here) - 1)
        return np.where(here[i] == at, ident[i], -1).astype(np.int64)

    def equal(self, k: int, ok: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = ok.copy()
        where = np.flatnonzero(ok)
        ident = self.get(k, a[where])
        out[where] = (ident >= 0) & (ident == self.get(k, b[where]))
        return out


def crossing(g: Grammar, blocks: Blocks) -> tuple[np.ndarray, ...]:
    """(owner, start, end, period) of the runs that cross the boundary of each nonterminal and of the axiom."""
    found = [np.zeros((0, 3), np.int64)]
    for k, (at, gap) in enumerate(blocks.near):
        size, step = 1 << k, max(1, 1 << k >> 1)
        for t in range(1, EXPONENT) if k == 0 else range(2 * EXPONENT):
            m = at + t * step
            ok = m < blocks.n
            p, m, q = at[ok], m[ok], gap[ok]
            ok = (g.low[m] >= 0) & (g.low[m] <= p) & (p + size + q <= g.high[m])
            found.append(np.stack([m[ok], q[ok], p[ok]], axis=1))
    rows = np.concatenate(found)
    if len(rows):
        _, once = np.unique((rows[:, 0] << 32) | rows[:, 1], return_index=True)
        rows = rows[once]
    m, q, p = rows.T
    low, high = g.low[m], g.high[m]
    start, end = p.copy(), p + q
    for k in range(len(blocks.levels) - 1, -1, -1):  # both extensions, longest blocks first
        size = 1 << k
        end = end + size * blocks.equal(k, end + size <= high, end - q, end)
        start = start - size * blocks.equal(k, start - size >= low, start - size, start - size + q)
    long = (end - start >= np.maximum(LEAST, EXPONENT * q)) & (start < m) & (m < end)
    return g.owner[m][long], start[long], end[long], q[long]


def runs_of(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, ordered by start and period; word numbers of the whole slice."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order, rank, _ = _ranked((doc << 32) | symbols)
    own = np.empty(len(symbols), np.int64)  # the same word in two documents is two symbols
    own[order] = rank
    g = Grammar(own, bounds)
    owner, start, end, q = crossing(g, Blocks(own, g.stop))
    which, start, end = g.derived(owner, start, end)
    q = q[which]
    if not len(q):
        return start, end, q
    by = np.lexsort((-end, start, q))
    start, end, q = start[by], end[by], q[by]
    reach = np.maximum.accumulate(q * (len(symbols) + 1) + end)  # furthest end so far among equal periods
    fresh = np.ones(len(q), dtype=bool)
    fresh[1:] = (q[1:] != q[:-1]) | (reach[:-1] - q[1:] * (len(symbols) + 1) - start[1:] < q[1:])
    head = np.flatnonzero(fresh)
    start, end, q = start[head], np.maximum.reduceat(end, head), q[head]
    by = np.lexsort((q, start))
    return start[by], end[by], q[by]


def planted(ids: np.ndarray, h: int) -> np.ndarray:
    """The contract's planted period in a document's words."""
    n = len(ids)
    if h % 10 or not n:
        return ids
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return ids[np.where(at < a, at, a + (at - a) % p)]


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def run_rows(texts: pa.Array, hashes: np.ndarray, plant: bool) -> Iterator[tuple]:
    """(n_runs, start, length, period, exponent_milli, runs digest, collapsed digest) per text; hashes: the contract's crc32."""
    cut = words.cut(texts, words.NOT_SPACE)
    ids, bounds = cut.ids, cut.bounds
    if plant:
        for i in np.flatnonzero(hashes % 10 == 0):
            ids[bounds[i]:bounds[i + 1]] = planted(ids[bounds[i]:bounds[i + 1]], int(hashes[i]))
    start, end, q = runs_of(ids, bounds)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, start + q, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change[:-1]) == 0
    spelt = np.array(cut.vocabulary.to_pylist(), dtype=object)
    first = np.searchsorted(start, bounds)
    for i in range(len(texts)):
        lo, hi = bounds[i], bounds[i + 1]
        mine = [(int(s - lo), int(e - s), int(p)) for s, e, p in zip(*(x[first[i]:first[i + 1]].tolist() for x in (start, end, q)))]
        best = max(mine, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if mine else (None, None, None)
        text = b" ".join(spelt[ids[lo:hi] if not mine else ids[lo:hi][kept[lo:hi]]]) if hi > lo else b""
        yield (len(mine), *best, 1000 * best[1] // best[2] if mine else None,
               _digest("".join(f"{s},{n},{p}\n" for s, n, p in mine).encode()), _digest(text))


FIELDS = [("n_runs", "long", pa.int64()), ("start", "long", pa.int64()), ("length", "long", pa.int64()), ("period", "long", pa.int64()),
          ("exponent_milli", "long", pa.int64()), ("runs_sha256", "string", pa.string()), ("collapsed_sha256", "string", pa.string())]


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per row of (doc_id, text): number of runs, the run of the greatest
    exponent, digests of all runs and of the text with repeated periods dropped.
    ``plant``: put the contract's periods into every tenth document first."""
    crc = F.crc32(F.coalesce(F.col("`doc_id`").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col("`doc_id`").alias("doc_id"), text_or_empty().alias("text"), crc.alias("h"))

    def run(batches):
        for b in batches:
            texts, hashes = b.column(1), b.column(2).to_numpy(zero_copy_only=False)
            for i, j in words.slices(texts):
                cols = list(zip(*run_rows(texts.slice(i, j - i), hashes[i:j], plant)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *(pa.array(c, t) for c, (_, _, t) in zip(cols, FIELDS))],
                                                 names=["doc_id", *(f for f, _, _ in FIELDS)])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{f} {t}" for f, t, _ in FIELDS))
