"""Code points of Arrow text, and a worker's cache from text units to what a tokenizer makes of them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from granary.llm import common as C

#: Units that a worker's cache holds at most; a full cache starts anew, which costs time and changes nothing.
CACHED_UNITS = 1 << 18


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a string column, and n+1 offsets; nulls are empty."""
    raw, offs = C.text_buffer(column)
    chars = C.char_index(raw)
    return np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32), chars[offs]


class UnitCache:
    """For each distinct unit (a span of code points, known by its hash) a list of numbers, made once."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = CACHED_UNITS) -> None:
        self.make, self.limit = make, limit
        self._clear()

    def _clear(self) -> None:
        self.index = C.HashIndex(1 << 14)
        self.first, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.flat, self.used = np.zeros(1 << 14, np.int32), 0

    def _store(self, h: np.ndarray, flat: np.ndarray, count: np.ndarray) -> None:
        at = self.index.add(h)
        if self.index.n > len(self.first):
            room = 2 * self.index.n
            self.first, self.count = np.resize(self.first, room), np.resize(self.count, room)
        if self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + len(flat)))
        self.flat[self.used : self.used + len(flat)] = flat
        self.count[at] = count
        self.first[at] = self.used + np.cumsum(count) - count
        self.used += len(flat)

    def numbers(self, cps: np.ndarray, s: np.ndarray, e: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The units' places in the cache; unknown ones are made now."""
        if self.index.n > self.limit:
            self._clear()
        n = self.index.get(h)
        miss = np.flatnonzero(n < 0)
        if len(miss):
            new, at = np.unique(h[miss], return_index=True)
            a, b = s[miss[at]].tolist(), e[miss[at]].tolist()
            whole = cps.tobytes().decode("utf-32-le")
            self._store(new, *self.make([whole[x:y] for x, y in zip(a, b)]))
            n[miss] = self.index.get(h[miss])
        return n

    def lists(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated lists of the units with these places, and their lengths."""
        count = self.count[n].astype(np.int64)
        unit, within = C.ragged(count)
        return self.flat[self.first[n][unit] + within], count
