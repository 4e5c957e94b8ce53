"""A minimal perfect hash of 64-bit keys, built and looked up by whole arrays."""

from __future__ import annotations

import numpy as np

from chatlake.llm.common import mixed

#: Slots for each key that a level still has to place.
ROOM = 2.0
MOST_LEVELS = 200
_STEP = 0x9E3779B97F4A7C15


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct keys.

    Each level throws the keys that are left at twice as many slots. A key alone in its slot is
    placed: its number is the count of used slots before it, over all levels. The others go to the
    next level. Keys are kept by number, so a key from outside the set is recognised.
    """

    def __init__(self, keys: np.ndarray):
        left = np.unique(np.asarray(keys, np.int64))
        self.keys = np.empty(len(left), np.int64)
        self.levels: list[np.ndarray] = []
        placed = 0
        while len(left):
            if len(self.levels) == MOST_LEVELS:
                raise RuntimeError("keys could not be placed")
            size = max(2, int(ROOM * len(left)))
            slots = self._slots(left, len(self.levels), size)
            alone = np.bincount(slots, minlength=size) == 1
            # The number of each used slot, -1 for the others.
            numbers = np.where(alone, placed + np.cumsum(alone) - 1, -1)
            self.levels.append(numbers)
            own = numbers[slots]
            self.keys[own[own >= 0]] = left[own >= 0]
            placed += int(alone.sum())
            left = left[own < 0]

    def __len__(self) -> int:
        return len(self.keys)

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((_STEP * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        return (mixed(keys.view(np.uint64) ^ salt) % np.uint64(size)).astype(np.int64)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for keys that are not in the set."""
        keys = np.ascontiguousarray(keys, np.int64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, numbers in enumerate(self.levels):
            if not len(open_):
                break
            out[open_] = numbers[self._slots(keys[open_], level, len(numbers))]
            open_ = open_[out[open_] < 0]
        found = np.flatnonzero(out >= 0)
        strange = found[self.keys[out[found]] != keys[found]]
        out[strange] = -1
        return out
