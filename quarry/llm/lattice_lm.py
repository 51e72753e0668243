"""Language-model scores from subword lattices.

A word is a lattice: every piece of an existing vocabulary that matches
somewhere is an edge. Its probability is the sum over all segmentations of the
product of the pieces' probabilities, by the forward recursion in log space; a
text's probability is the product over its words and the end. Pieces never hold
a space mark inside, so a word's lattice is independent of its neighbours.

The vocabulary file's scores weight the pieces: in a merge-type vocabulary the
score is the merge's rank, and a piece's weight falls with a power of it. One
expectation step over the lattices of all distinct training words gives the
expected use of every piece. From these the power is fitted by likelihood, and
the piece's probability is SCORE_SHARE of what its score says and for the rest its share
of the expected uses. So the file's scores weight every segmentation at
every size of the corpus, and a piece that the corpus doesn't use keeps what its score gives.

Word counts come from the whole training part. Documents are handled in blocks
of bounded size: a block asks for the words it holds (one row per word and
block), counts and probabilities are joined to these rows by word, and the
answered rows meet the block's documents again, each block in a task of its own: the
blocks are numbered without gaps and dealt by that number, so a task reads one block
however large the input is. Only the probabilities of the vocabulary's pieces and the
number of blocks of each scan task pass the driver.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, materialised, only, text_or_empty
from .lookup import KeyTable
from .pieces import MARK, Vocabulary, vocabulary

BLOCK_BYTES = 48 << 20   # text of a block
LONG_WORD = 40           # longer words take the loop instead of the matrix
SCORE_SHARE = 0.1        # of a piece's probability that its score alone decides
UNIT = 1e-6              # expected counts are sums of multiples of this, so their order doesn't matter
END = b""                # the end token among the words
_BASE = np.uint64(0x100000001B3)  # fixed value: the 64-bit FNV prime, as the base of the substring hashes


class Lattice:
    """Edges and recursions over the pieces of a vocabulary. Index ``size`` of the weights is the end token."""

    def __init__(self, voc: Vocabulary):
        self.size, self.normal, self.byte_id = voc.size, voc.normal, voc.byte_id
        self.longest = max(map(len, voc.normal))
        keys, ids = [], []
        for piece, i in voc.normal.items():
            h = 1
            for c in piece:
                h = (h * int(_BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
            keys.append(h)
            ids.append(i)
        self.table = KeyTable(np.array(keys, dtype=np.uint64), np.array(ids))

    def depth(self, voc: Vocabulary) -> np.ndarray:
        """Log of 2 plus the rank of each piece's score; pieces without one (bytes, the end token) stand behind the last."""
        rank = np.full(self.size + 1, max(voc.rank.values(), default=0) + 1.0)
        for i, r in voc.rank.items():
            rank[i] = r
        return np.log(rank + 2)

    @staticmethod
    def score_weights(depth: np.ndarray, power: float = 1.0) -> np.ndarray:
        """Log weights that the file's scores give."""
        w = -power * depth
        return w - w.max() - math.log(np.exp(w - w.max()).sum())

    def char_bytes(self, code: int) -> list[int]:
        return [self.byte_id[b] for b in chr(code).encode("utf-8", "surrogatepass")]

    def edges(self, codes: np.ndarray) -> list[np.ndarray]:
        """Piece ids by length l and start: element l-1 is (words, starts); -1: no such piece."""
        n, length = codes.shape
        h, out = np.ones((n, length), dtype=np.uint64), []
        for size in range(1, min(self.longest, length) + 1):
            h = h[:, :length - size + 1] * _BASE + codes[:, size - 1:]
            out.append(self.table.get(h))
        return out

    def weights(self, codes: np.ndarray, edges: list[np.ndarray], logp: np.ndarray) -> list[np.ndarray]:
        """Log weight of every edge; a character that is no piece weighs as its bytes."""
        padded = np.append(logp, -np.inf)
        out = [padded[e] for e in edges]
        alone = edges[0] < 0
        if alone.any():
            seen, at = np.unique(codes[alone], return_inverse=True)
            out[0][alone] = np.array([logp[self.char_bytes(c)].sum() for c in seen.tolist()])[at]
        return out

    @staticmethod
    def forward(weights: list[np.ndarray], length: int) -> np.ndarray:
        n = len(weights[0])
        alpha = np.full((n, length + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, length + 1):
            ways = np.stack([alpha[:, j - k - 1] + weights[k][:, j - k - 1] for k in range(min(len(weights), j))])
            top = ways.max(axis=0)
            alpha[:, j] = top + np.log(np.exp(ways - top).sum(axis=0))
        return alpha

    @staticmethod
    def backward(weights: list[np.ndarray], length: int) -> np.ndarray:
        n = len(weights[0])
        beta = np.full((n, length + 1), -np.inf)
        beta[:, length] = 0.0
        for i in range(length - 1, -1, -1):
            ways = np.stack([weights[k][:, i] + beta[:, i + k + 1] for k in range(min(len(weights), length - i))])
            top = ways.max(axis=0)
            beta[:, i] = top + np.log(np.exp(ways - top).sum(axis=0))
        return beta

    def log_probability(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability of each word (with the space mark in front)."""
        out = np.zeros(len(words))
        for codes, at in self._groups(words):
            edges = self.edges(codes)
            out[at] = self.forward(self.weights(codes, edges, logp), codes.shape[1])[:, -1]
        for i in [i for i, w in enumerate(words) if len(w) >= LONG_WORD]:
            out[i] = self._long(words[i], logp)[-1]
        return out

    def expected(self, words: list[str], counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the words (each as often as its count), in units of UNIT."""
        total = np.zeros(self.size + 1)
        for codes, at in self._groups(words):
            length, edges = codes.shape[1], self.edges(codes)
            w = self.weights(codes, edges, logp)
            a, b = self.forward(w, length), self.backward(w, length)
            whole, times = a[:, -1:], counts[at][:, None]
            for k, (ids, weight) in enumerate(zip(edges, w)):
                use = np.rint(np.exp(a[:, :length - k] + weight + b[:, k + 1:] - whole) * times / UNIT)
                there = ids >= 0
                total += np.bincount(ids[there], use[there], minlength=self.size + 1)
                if k == 0 and not there.all():
                    seen, place = np.unique(codes[~there], return_inverse=True)
                    for c, u in zip(seen.tolist(), np.bincount(place, use[~there])):
                        for i in self.char_bytes(c):
                            total[i] += u
        for i in [i for i, w in enumerate(words) if len(w) >= LONG_WORD]:
            self._long_expected(words[i], float(counts[i]), logp, total)
        return total

    def _groups(self, words: list[str]):
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            if len(w) < LONG_WORD:
                by_length[len(w)].append(i)
        for n, at in by_length.items():
            for lo in range(0, len(at), 20_000):
                some = at[lo:lo + 20_000]
                text = "".join([MARK + words[i] for i in some])
                yield np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(some), n + 1).astype(np.uint64), np.array(some)

    def _ways(self, text: str, j: int, logp: np.ndarray):
        """(start, piece ids, log weight) of the edges that end at j."""
        for k in range(1, min(self.longest, j) + 1):
            i = self.normal.get(text[j - k:j])
            if i is not None:
                yield j - k, [i], logp[i]
            elif k == 1:
                ids = self.char_bytes(ord(text[j - 1]))
                yield j - 1, ids, logp[ids].sum()

    def _long(self, word: str, logp: np.ndarray) -> list[float]:
        text = MARK + word
        alpha = [0.0]
        for j in range(1, len(text) + 1):
            alpha.append(_logsum([alpha[i] + w for i, _, w in self._ways(text, j, logp)]))
        return alpha

    def _long_expected(self, word: str, count: float, logp: np.ndarray, total: np.ndarray) -> None:
        text, alpha = MARK + word, self._long(word, logp)
        beta = [[] for _ in alpha]
        beta[-1] = [0.0]
        for j in range(len(text), 0, -1):
            after = _logsum(beta[j])
            for i, ids, w in self._ways(text, j, logp):
                beta[i].append(after + w)
                use = round(math.exp(alpha[i] + w + after - alpha[-1]) * count / UNIT)
                for k in ids:
                    total[k] += use
            beta[j] = [after]


def _logsum(ways: list[float]) -> float:
    top = max(ways)
    return top + math.log(sum(math.exp(w - top) for w in ways))


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(vocabulary(path))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space


def in_blocks(docs: DataFrame, id_col: str, text_col: str, mod: int, rest: int, block_bytes: int) -> DataFrame:
    """doc_id, text, held_out, block: consecutive rows of a scan task, up to about ``block_bytes`` of text (a longer text is alone)."""
    rows = (only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .withColumn("held_out", crc_mod(F.col("doc_id"), mod) == rest))

    def number(batches):
        block, size = TaskContext.get().partitionId() << 24, 0
        for b in batches:
            lengths = pa.compute.binary_length(b.column(1)).to_numpy(zero_copy_only=False)
            blocks = np.empty(b.num_rows, dtype=np.int64)
            for i, n in enumerate(lengths.tolist()):
                if size and size + n > block_bytes:
                    block, size = block + 1, 0
                size += n
                blocks[i] = block
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(blocks)], names=["doc_id", "text", "held_out", "block"])

    return rows.mapInArrow(number, "doc_id long, text string, held_out boolean, block long")


def numbered(blocked: DataFrame) -> tuple[DataFrame, int]:
    """The rows with their blocks numbered 0, 1, ... without gaps, and the number of blocks."""
    scan = F.shiftright("block", 24)
    # one row per scan task of the input, on the driver as for zipWithIndex, and broadcast back
    last = blocked.groupBy(scan.alias("scan")).agg(F.max(F.col("block").bitwiseAND((1 << 24) - 1)).alias("last")).orderBy("scan").collect()
    first, total = [], 0
    for r in last:
        first.append((r.scan, total))
        total += r["last"] + 1
    offsets = F.broadcast(blocked.sparkSession.createDataFrame(first, "scan long, first long"))
    number = (F.col("first") + F.col("block").bitwiseAND((1 << 24) - 1)).cast("int")
    return blocked.join(offsets, scan == F.col("scan")).select("doc_id", "text", "held_out", number.alias("block")), total


def asked_words(blocked: DataFrame) -> DataFrame:
    """block, word, n: the distinct words of each block (the end token too) and how often its training rows hold them."""

    def run(batches):
        block, known, counts = None, set(), Counter()

        def answer():
            every = list(known)
            for lo in range(0, len(every), 50_000):
                some = every[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), block, dtype=np.int32)), pa.array(some, pa.binary()), pa.array([counts[w] for w in some], pa.int64())],
                                                 names=["block", "word", "n"])

        for b in batches:
            for lo in range(0, b.num_rows, 500):
                for text, out, at in zip(*(c.to_pylist() for c in b.slice(lo, 500).columns)):
                    if at != block:
                        if block is not None:
                            yield from answer()
                        block, known, counts = at, set(), Counter()
                    words = [*words_of(text), END]
                    known.update(words)
                    if not out:
                        counts.update(words)
        if block is not None:
            yield from answer()

    return blocked.select("text", "held_out", "block").mapInArrow(run, "block int, word binary, n long")


def fitted_power(uses: np.ndarray, depth: np.ndarray) -> float:
    """The power under which the scores' weights make the uses likeliest (their mean depth is then the weights' mean depth)."""
    want, lo, hi = float(uses @ depth / uses.sum()), 0.0, 8.0
    for _ in range(50):  # the weights' mean depth falls with the power
        power = (lo + hi) / 2
        lo, hi = (power, hi) if float(np.exp(Lattice.score_weights(depth, power)) @ depth) > want else (lo, power)
    return (lo + hi) / 2


def piece_probabilities(counted: DataFrame, path: str) -> np.ndarray:
    """Log probabilities of the pieces and the end token from (word, c)."""
    depth = lattice(path).depth(vocabulary(path))
    first = Lattice.score_weights(depth)

    def run(batches):
        lat, total = lattice(path), np.zeros(len(first))
        for b in batches:
            for lo in range(0, b.num_rows, 50_000):
                part = b.slice(lo, 50_000)
                words, counts = part.column(0).to_pylist(), part.column(1).to_numpy(zero_copy_only=False).astype(float)
                if END in words:
                    total[-1] += counts[words.index(END)] / UNIT
                go = [i for i, w in enumerate(words) if w != END]
                total += lat.expected([words[i].decode("utf-8", "surrogatepass") for i in go], counts[go], first)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

    # one row per piece of the vocabulary
    uses = counted.mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum(F.col("uses").cast("decimal(38,0)")).alias("uses")).collect()
    total = np.zeros(len(first))
    for r in uses:
        total[r.piece] = float(r.uses) * UNIT
    if not total.any():
        return first
    by_score = np.exp(Lattice.score_weights(depth, fitted_power(total, depth)))
    return np.log(SCORE_SHARE * by_score + (1 - SCORE_SHARE) * total / total.sum())


def lm_scores(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", held_out_mod: int = 7, held_out_rest: int = 2,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, A-Z lower-cased, and one end; counts come from the rows
    that are not held out (crc32 of the id as text, modulo). base_score is the
    add-one unigram log10 probability of the tokens; score the log10
    probability of the text under the lattice model. A null text is empty: one
    end token. Without training rows counts are 0 and pieces weigh what their scores give. Empty
    input: no rows.
    """
    blocked, blocks = numbered(materialised(in_blocks(docs, id_col, text_col, held_out_mod, held_out_rest, block_bytes), "lm-blocks", "zstd"))
    tasks = max(1, blocks)
    by_word = Window.partitionBy("word")
    answers = materialised(asked_words(blocked).select("block", "word", F.sum("n").over(by_word).alias("c"),
                                                       (F.row_number().over(by_word.orderBy("block")) == 1).alias("first")), "lm-words", "zstd")
    once = answers.where("first and c > 0").select("word", "c")
    sums = once.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens, base = int(sums.n), int(sums.n) + int(sums.v) + 1
    logp = piece_probabilities(once, path)

    def score(batches):
        lat, last = lattice(path), (b"\xff", 0.0)
        for b in batches:
            for lo in range(0, b.num_rows, 50_000):
                part = b.slice(lo, 50_000)
                words = part.column(1).to_pylist()
                new = [i for i, w in enumerate(words) if w != END and w != (words[i - 1] if i else last[0])]  # rows of a word stand together
                value = dict(zip([words[i] for i in new], lat.log_probability([words[i].decode("utf-8", "surrogatepass") for i in new], logp).tolist()))
                value |= {last[0]: last[1]} if last[0] not in value else {}
                value[END] = float(logp[-1])
                out = [value[w] for w in words]
                last = (words[-1], out[-1])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(out)], names=["block", "word", "c", "logp"])

    scored = answers.select("block", "word", "c").mapInArrow(score, "block int, word binary, c long, logp double")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {w: i for i, w in enumerate(right["word"].to_pylist())}
        c, value = right["c"].to_numpy(), right["logp"].to_numpy() / math.log(10)
        plain = np.log10((c + 1) / base)
        out = []
        for b in left.select(["text"]).to_batches(max_chunksize=500):
            for text in b.column(0).to_pylist():
                at = np.fromiter(map(row.__getitem__, [*words_of(text), END]), dtype=np.int64)  # a missing word fails
                out.append((len(at), int((c[at] > 0).sum()), float(plain[at].sum()), float(value[at].sum())))
        n, known, b_score, s = zip(*out) if out else ((), (), (), ())
        return pa.table({"doc_id": left["doc_id"], "held_out": left["held_out"], "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(known, pa.int64()),
                         "train_tokens": pa.array([train_tokens] * len(n), pa.int64()), "base_score": pa.array(b_score, pa.float64()), "score": pa.array(s, pa.float64())})

    scored = scored.select(F.col("block").alias("w_block"), "word", "c", "logp").repartitionById(tasks, "w_block")
    return blocked.repartitionById(tasks, "block").groupBy("block").cogroup(scored.groupBy("w_block")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
