"""A read-only table from 64-bit keys to small integers, asked for whole numpy arrays at once."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: 2**64 over the golden ratio, odd


class KeyTable:
    """Open addressing; absent keys give -1. The key 2**64 - 1 marks free slots and is not allowed."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = keys.astype(np.uint64)
        self.bits = max(8, int(np.ceil(np.log2(max(1, 4 * len(keys))))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(1 << self.bits, -1, dtype=np.int64)
        at, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):
            self.probes += 1
            free = self.keys[at[todo]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(at[todo], return_index=True)
            chosen = np.zeros(len(todo), dtype=bool)
            chosen[first] = True
            won = todo[free & chosen]
            self.keys[at[won]], self.values[at[won]] = keys[won], values[won]
            todo = todo[~(free & chosen)]
            same = self.keys[at[todo]] == keys[todo]
            todo = todo[~same]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        shape, keys = keys.shape, keys.astype(np.uint64).ravel()
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        todo = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out.reshape(shape)


class PairTable:
    """KeyTable over pairs of integers below 2**32."""

    def __init__(self, first: np.ndarray, second: np.ndarray, values: np.ndarray):
        self.table = KeyTable(self._key(first, second), values)

    @staticmethod
    def _key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return (first.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)

    def get(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.table.get(self._key(first, second))
