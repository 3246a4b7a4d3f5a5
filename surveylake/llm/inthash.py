"""A map from integers to integers that is looked up for whole arrays at a time."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


class IntHash:
    """Open addressing with linear probing. Keys and values are non-negative; a key and its value lie side by side."""

    def __init__(self, bits: int = 12):
        self.size = 0
        self._allocate(bits)

    def _allocate(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.cells = np.full((1 << bits, 2), -1, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _ODD) >> self.shift).view(np.int64)

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys that are distinct and not held yet."""
        self.size += len(keys)
        if 3 * self.size > self.mask:
            held = self.cells[self.cells[:, 0] >= 0]
            self._allocate(int(3 * self.size).bit_length())
            self._place(held)
        self._place(np.stack([keys, values], 1).astype(np.int64))

    def _place(self, new: np.ndarray) -> None:
        slots = self._slots(np.ascontiguousarray(new[:, 0]))
        while len(new):
            free = self.cells[slots, 0] < 0
            self.cells[slots[free]] = new[free]  # of several keys for one slot one gets it
            left = self.cells[slots, 0] != new[:, 0]
            new, slots = new[left], (slots[left] + 1) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it is not held."""
        slots = self._slots(keys)
        found = self.cells.take(slots, axis=0)
        values = found[:, 1]
        todo = np.flatnonzero(found[:, 0] != keys)
        if len(todo):
            todo = todo[values[todo] >= 0]
            values[np.flatnonzero((found[:, 0] != keys))] = -1
        while len(todo):
            slots[todo] = (slots[todo] + 1) & self.mask
            cells = self.cells.take(slots[todo], axis=0)
            hit = cells[:, 0] == keys[todo]
            values[todo[hit]] = cells[hit, 1]
            todo = todo[~hit & (cells[:, 0] >= 0)]
        return values
