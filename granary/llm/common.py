"""Shared plumbing: Arrow text buffers, vectorised words and hashes, checkpoints and size-checked joins.

Everything here works on whole texts. A null text counts as an empty one; a null ``doc_id`` is carried
through unless an operator's docstring says otherwise.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.lineage import cut, made, shared_folder, written  # noqa: F401  (the operators take them from here)

U64 = np.uint64
#: Bytes of text that one vectorised step handles; a longer document is a step of its own.
STEP_BYTES = 1 << 19
#: A side of a join is broadcast up to this size, beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
LONG_SPAN = 64


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its counted rows stay under limit bytes, else unhinted. Give it a cut() frame."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def same_names(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the wanted columns, by exact name, so extra or clashing columns of the input can't interfere."""
    return df.select(*[df[f"`{c}`"].alias(c) for c in wanted])


def fresh(df: DataFrame, name: str) -> str:
    """name, or a longer one that df has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# ---------------------------------------------------------------- Arrow buffers


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and n+1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(batch: pa.RecordBatch, place: int, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in slices whose texts, in the column at place, have about size bytes."""
    n, at = batch.num_rows, 0
    if not n:
        return
    _, offs = text_buffer(batch.column(place))
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        yield batch.slice(at, min(to, n) - at)
        at = to
    give_back()


def give_back() -> None:
    """Return what the allocators have free to the system: a worker that is used again keeps nothing from its last task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def steps(batch: pa.RecordBatch, column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    return slices(batch, batch.schema.get_field_index(column), size)


# ---------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x.astype(U64, copy=True)
    x += U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_Q = 0x9E3779B97F4A7C15 | 1
_QINV = pow(_Q, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=U64)) | U64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        m = 1 << max(16, int(n - 1).bit_length())
        a = np.full(m, base, U64)
        a[0] = 1
        have = np.multiply.accumulate(a)
        if m <= 1 << 22:
            _powers[base] = have
    return have[:n]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of symbols[start:end] for each span; equal symbols give equal hashes wherever they lie.

    A polynomial modulo 2**64, whose known collisions need hundreds of symbols; spans of bytes or code points of over
    LONG_SPAN get a cryptographic digest in its place, so that no text can be made up to collide.
    """
    n = len(symbols)
    if not len(starts):
        return np.zeros(0, U64)
    if symbols.dtype == np.uint8:
        v = _BYTE[symbols]
    elif symbols.dtype == U64:
        v = symbols.copy()
    else:
        v = mix(symbols.astype(U64))
    v *= powers(_Q, n)
    total = np.zeros(n + 1, U64)
    np.cumsum(v, out=total[1:])
    h = mix((total[ends] - total[starts]) * powers(_QINV, n + 1)[starts] + (ends - starts).astype(U64))
    if symbols.dtype != U64:
        for k in np.flatnonzero(ends - starts > LONG_SPAN).tolist():
            h[k] = int.from_bytes(hashlib.blake2b(symbols[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return h


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def runs(flag: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the runs of True; a document boundary ends a run."""
    n = len(flag)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[offs] = True  # document starts (and n)
    start = flag.copy()
    start[1:] &= ~flag[:-1] | edge[1:n]
    end = flag.copy()
    end[:-1] &= ~flag[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offs, s, "right") - 1


def words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of ASCII letters, digits, underscore and non-ASCII bytes): start, end, document, hash."""
    s, e, d = runs(_WORD[raw], offs)
    return s, e, d, span_hashes(raw, s, e)


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """White-space separated tokens: start, end, document, hash."""
    s, e, d = runs(~_SPACE[raw], offs)
    return s, e, d, span_hashes(raw, s, e)


def char_index(raw: np.ndarray) -> np.ndarray:
    """For each byte position 0..n the number of characters before it."""
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=at[1:])
    return at


def lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


class HashIndex:
    """Open-addressing table from 64-bit hashes to dense numbers 0, 1, ... with vectorised probing."""

    def __init__(self, capacity: int = 1 << 16) -> None:
        self.n = 0
        self._room(capacity)

    def _room(self, capacity: int) -> None:
        self.mask = U64(capacity - 1)
        self.keys = np.zeros(capacity, U64)
        self.values = np.full(capacity, -1, np.int64)

    def get(self, h: np.ndarray) -> np.ndarray:
        """The numbers of h; -1 where unknown."""
        out = np.full(len(h), -1, np.int64)
        slot = (h & self.mask).astype(np.int64)
        k, v = self.keys[slot], self.values[slot]
        hit = (k == h) & (v >= 0)
        out[hit] = v[hit]
        left = np.flatnonzero(~hit & (v >= 0))
        step = 1
        while len(left):
            at = (slot[left] + step) & int(self.mask)
            k, v = self.keys[at], self.values[at]
            hit = (k == h[left]) & (v >= 0)
            out[left[hit]] = v[hit]
            left = left[~hit & (v >= 0)]
            step += 1
        return out

    def add(self, h: np.ndarray) -> np.ndarray:
        """Add distinct, unknown hashes; their new numbers in order."""
        if (self.n + len(h)) * 2 > len(self.keys):
            old = self.keys[self.values >= 0], self.values[self.values >= 0]
            self._room(1 << int((self.n + len(h)) * 4 - 1).bit_length())
            self._place(*old)
        new = np.arange(self.n, self.n + len(h), dtype=np.int64)
        self._place(h, new)
        self.n += len(h)
        return new

    def _place(self, h: np.ndarray, numbers: np.ndarray) -> None:
        at = (h & self.mask).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            slot = at[left]
            free = self.values[slot] < 0
            cand, where = left[free], slot[free]
            self.values[where] = numbers[cand]  # of several on one slot the last stays
            won = self.values[where] == numbers[cand]
            self.keys[where[won]] = h[cand[won]]
            placed = np.zeros(len(h), bool)
            placed[cand[won]] = True
            left = left[~placed[left]]
            at[left] = (at[left] + 1) & int(self.mask)


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of these lengths: the row of each element, and its place within the row."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    first = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=first[1:])
    return row, np.arange(first[-1]) - first[row]


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and row lengths."""
    offs = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))


@lru_cache(maxsize=1)
def arrow_types() -> dict[str, pa.DataType]:
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
