"""An open-addressing table from 64-bit keys to floats, looked up by whole arrays."""

from __future__ import annotations

import numpy as np

FREE = -1


class CodeTable:
    """Keys are non-negative; ``find`` gives NaN for absent ones."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(3 * max(1, len(keys))).bit_length())
        self.keys = np.full(1 << self.bits, FREE, np.int64)
        self.values = np.full(1 << self.bits, np.nan, np.float32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            open_ = todo[self.keys[at[todo]] == FREE]
            slots, chosen = np.unique(at[open_], return_index=True)
            put = open_[chosen]
            self.keys[slots], self.values[slots] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            todo = todo[left[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.values[at]
        held = self.keys[at]
        out[held != keys] = np.nan
        wrong = np.flatnonzero((held != keys) & (held != FREE))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[wrong]]
            hit = held == keys[wrong]
            out[wrong[hit]] = self.values[at[wrong[hit]]]
            wrong = wrong[~hit & (held != FREE)]
        return out
