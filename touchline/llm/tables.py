"""Packed hash tables of numpy arrays, for models that workers look up in bulk."""

from __future__ import annotations

import numpy as np


class Lookup:
    """A vectorised hash table from 64-bit keys to one value each; keys that aren't in it get the missing value."""

    FREE = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: float) -> None:
        self._fill(keys, values, missing)

    def __getstate__(self) -> tuple:
        """Only what is held, without free places, for broadcasts."""
        used = self.keys != self.FREE
        return self.keys[used], self.values[used], self.missing, {k: v for k, v in self.__dict__.items() if k not in ("keys", "values", "bits", "mask", "missing")}

    def __setstate__(self, state: tuple) -> None:
        keys, values, missing, more = state
        self._fill(keys, values, missing)
        self.__dict__.update(more)

    def _fill(self, keys: np.ndarray, values: np.ndarray, missing: float) -> None:
        self.bits = max(4, int(1.4 * len(keys) + 1).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, self.FREE)
        self.values = np.full(1 << self.bits, missing, values.dtype)
        self.missing = missing
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == self.FREE]
            self.keys[at[free]] = keys[free]
            placed = self.keys[at[left]] == keys[left]
            self.values[at[left[placed]]] = values[left[placed]]
            left = left[~placed]
            at[left] = (at[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        there = self.keys[at]
        out = self.values[at]
        off = np.flatnonzero(there != keys)
        out[off] = self.missing
        off = off[there[off] != self.FREE]
        while len(off):
            at[off] = (at[off] + 1) & self.mask
            there_now = self.keys[at[off]]
            hit = there_now == keys[off]
            out[off[hit]] = self.values[at[off[hit]]]
            off = off[~hit & (there_now != self.FREE)]
        return out
