"""The words of whole Arrow batches as integers, cut from the UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once inside a task (UTF-8 bytes); a longer text is alone.
SLICE_BYTES = 2_000_000


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry table, True for the bytes outside all the given ranges (both ends included)."""
    out = np.ones(256, dtype=bool)
    for first, last in ranges:
        out[first:last + 1] = False
    return out


#: `[^\\x20\\x09-\\x0D]+`
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`
LOWER_OR_DIGIT = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


class Words(NamedTuple):
    ids: np.ndarray     # one per word: index into vocabulary
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]
    vocabulary: pa.Array  # the distinct words as bytes


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint8)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` bytes together."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


def cut(texts: pa.Array, is_word: np.ndarray, fold: bool = False) -> Words:
    """Words of texts without nulls: the longest stretches of bytes in ``is_word``; ``fold`` lower-cases A-Z first."""
    if not len(texts):
        return Words(np.zeros(0, np.int64), np.zeros(1, np.int64), pa.array([], pa.binary()))
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if fold:
        data = lower_ascii(data)
    kind = is_word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True  # a word never reaches over the end of a text
    first = kind.copy()
    first[1:] &= ~kind[:-1] | edge[1:-1]
    last = kind.copy()
    last[:-1] &= ~kind[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    ends = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.flatnonzero(last) - starts + 1, out=ends[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[kind])]).dictionary_encode()
    return Words(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(starts, offsets), words.dictionary)
