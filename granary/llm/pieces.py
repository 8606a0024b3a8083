"""SentencePiece encoding and decoding for merge-type vocabularies, by an agenda of adjacent symbol pairs.

A text's characters are its first symbols. The agenda holds the adjacent pairs whose concatenation is a piece,
the best score first and of equal scores the leftmost; the best pair is merged and the pairs beside it are
replaced, until the agenda is empty. Characters that are no piece become their bytes' pieces, or the unknown one.

No pair can ever merge across two adjacent characters that are adjacent in no piece, so a text falls apart exactly
there into independent units. Units are encoded once per worker: a batch's new units are stacked into arrays, and
every step pops the head of each unit's agenda at once; units of over ``LONG`` symbols use a heap. In each Arrow
batch the new units are encoded by the sentencepiece library too, and a difference raises an error, so everything a
result is made of has been compared with the library.

Nulls and edges: a null or empty text has no pieces and decodes to an empty text; a null doc_id is carried
through; equal rows give equal rows; extra columns are ignored; an empty table gives no rows. A text that holds
the character U+2581 decodes to one with blanks in its place, as the library has it; ``round_trip`` is false then.
Vocabularies with a normaliser that changes text, with user-defined symbols or without byte pieces are refused. A
very long text is encoded whole, as a step of its own; of pairs with equal scores the leftmost merges.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common as C
from granary.llm.units import UnitCache, code_points

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
LONG = 48
BLANK = 0x2581
_BUCKETS = (2, 4, 6, 8, 12, 16, 24, 32, LONG)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + n]
            at += n


class Vocabulary:
    """What encoding and decoding need of a model file."""

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        trainer: dict = {}
        normal: dict = {}
        kinds = []
        with open(path, "rb") as f:
            self.data = f.read()
        for number, value in _fields(self.data):
            if number == 1:
                kinds.append(dict(_fields(value)).get(3, 1))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if trainer.get(3) != 2:
            raise ValueError(f"{path} is no merge-type vocabulary")
        if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1) or 4 in kinds:
            raise ValueError(f"{path}: only identity normalisation with escaped white space, and no user-defined symbols")
        self.prefix = bool(normal.get(3, 1))
        size = len(kinds)
        if kinds.count(6) < 256:
            raise ValueError(f"{path}: byte pieces are needed, so that each character has pieces of its own")
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        self.unknown = self.library.unk_id()
        score = np.array([self.library.get_score(i) for i in range(size)])
        _, level = np.unique(score, return_inverse=True)
        self.level = level.astype(np.int32)  # higher merges earlier
        number = {p: i for i, p in enumerate(self.pieces) if kinds[i] == 1}
        self.byte = np.full(256, -1, np.int32)
        for i, p in enumerate(self.pieces):
            if kinds[i] == 6:
                self.byte[int(p[1:-1], 16)] = i
        chars = sorted({c for p in number for c in p})
        self.char_class = np.zeros(0x110000, np.int32)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        # characters that are no piece themselves can't merge: they are numbered after the pieces
        self.symbol_of = {c: number.get(c, size + k) for k, c in enumerate(chars)}
        self.single = np.full(len(chars) + 1, -1, np.int32)
        self.single[1:] = [self.symbol_of[c] for c in chars]
        n = len(chars) + 1
        self.together = np.zeros(n * n, bool)
        for p in number:
            for a, b in zip(p, p[1:]):
                self.together[self.char_class[ord(a)] * n + self.char_class[ord(b)]] = True
        left, right, whole = [], [], []
        for p, i in number.items():
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                a = self.symbol_of.get(a) if k == 1 else number.get(a)
                b = self.symbol_of.get(b) if len(b) == 1 else number.get(b)
                if a is not None and b is not None:
                    left.append(a), right.append(b), whole.append(i)
        self.merges = C.HashIndex(1 << 20)
        key = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        self.merges.add(C.mix(key))
        self.whole = np.array(whole, np.int32)
        self.pair = dict(zip(zip(left, right), whole))
        self.bytes_of = [self._bytes(p, kinds[i]) for i, p in enumerate(self.pieces)]
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.size = np.array([len(b) for b in self.bytes_of], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def _bytes(self, piece: str, kind: int) -> bytes:
        if kind == 6:
            return bytes([int(piece[1:-1], 16)])
        if kind == 3:
            return b""
        return " ⁇ ".encode() if kind == 2 else piece.replace(chr(BLANK), " ").encode()

    # ---------------------------------------------------------------- encoding

    def _fallback(self, symbols: list[int], unit: str) -> list[int]:
        """Pieces' numbers for symbols, some of which may be characters that are no piece."""
        if all(x < len(self.pieces) and x >= 0 for x in symbols):
            return symbols
        out, at = [], 0
        for x in symbols:
            if 0 <= x < len(self.pieces):
                out.append(x)
                at += len(self.pieces[x])
            else:
                b = [int(self.byte[k]) for k in unit[at].encode()]
                out += b
                at += 1
        return out

    def heap(self, unit: str) -> list[int]:
        """One unit by an agenda that is a heap."""
        sym = [int(self.single[self.char_class[ord(c)]]) for c in unit]
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n:
                w = self.pair.get((sym[a], sym[b]))
                if w is not None:
                    heapq.heappush(agenda, (-int(self.level[w]), a, b, sym[a], sym[b]))

        for k in range(n - 1):
            offer(k, k + 1)
        gone = bytearray(n)
        while agenda:
            _, a, b, x, y = heapq.heappop(agenda)
            if gone[a] or gone[b] or sym[a] != x or sym[b] != y or right[a] != b:
                continue
            sym[a] = self.pair[x, y]
            gone[b] = 1
            right[a] = right[b]
            if right[b] < n:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return self._fallback([sym[k] for k in range(n) if not gone[k]], unit)

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that a and b make; -1 if none."""
        ok = (a >= 0) & (b >= 0)
        out = np.full(a.shape, -1, np.int32)
        key = (a[ok].astype(np.uint64) << np.uint64(32)) | b[ok].astype(np.uint64)
        at = self.merges.get(C.mix(key))
        out[ok] = np.where(at >= 0, self.whole[at], -1)
        return out

    def stacked(self, sym: np.ndarray) -> np.ndarray:
        """Agendas of many units at once: sym [units, symbols], padded by -2 at the end."""
        sym = sym.copy()
        made = self._look(sym[:, :-1], sym[:, 1:])
        rank = np.where(made >= 0, self.level[made], -1)
        rows = np.arange(len(sym))
        out = sym.copy()
        while len(rows):
            best = rank.argmax(axis=1)  # the first of equals
            go = rank[np.arange(len(rows)), best] >= 0
            out[rows[~go]] = sym[~go]
            rows, sym, made, rank, best = rows[go], sym[go], made[go], rank[go], best[go]
            if not len(rows):
                break
            r = np.arange(len(rows))
            sym[r, best] = made[r, best]
            width = sym.shape[1]
            shift = np.arange(width)[None, :] + (np.arange(width)[None, :] > best[:, None])
            shift = np.minimum(shift, width)
            sym = np.take_along_axis(np.pad(sym, ((0, 0), (0, 1)), constant_values=-2), shift, 1)
            shift = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > best[:, None])
            made = np.take_along_axis(np.pad(made, ((0, 0), (0, 1)), constant_values=-1), shift, 1)
            for place, ok in ((best, best < width - 1), (best - 1, best > 0)):
                k = np.flatnonzero(ok)
                made[k, place[k]] = self._look(sym[k, place[k]], sym[k, place[k] + 1])
            rank = np.where(made >= 0, self.level[made], -1)
        return out

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units' pieces one after the other, and how many each has; compared with the library."""
        size = np.array([len(u) for u in units])
        found: list[list[int]] = [[]] * len(units)
        low = 0
        for high in _BUCKETS:
            some = np.flatnonzero((size > low) & (size <= high))
            low = high
            if not len(some):
                continue
            cps, offs = code_points(pa.array([units[k] for k in some.tolist()], pa.string()))
            row, col = C.ragged(np.diff(offs))
            sym = np.full((len(some), high), -2, np.int32)
            sym[row, col] = self.single[self.char_class[cps]]
            for k, line in zip(some.tolist(), self.stacked(sym).tolist()):
                u = units[k]
                found[k] = self._fallback([x for x in line if x != -2], u)
        for k in np.flatnonzero(size > LONG).tolist():
            found[k] = self.heap(units[k])
        theirs = self.checker.encode(units, num_threads=1)
        for u, a, b in zip(units, found, theirs):
            if a != b:
                raise AssertionError(f"unit {u!r}: the agenda gives {a}, the library {b}")
        return np.array([x for y in found for x in y], np.int32), np.array([len(y) for y in found], np.int32)

    @property
    def checker(self) -> sentencepiece.SentencePieceProcessor:
        if not hasattr(self, "_checker"):
            # a message field that comes again is merged: this one turns off the blank before a text
            self._checker = sentencepiece.SentencePieceProcessor(model_proto=self.data + b"\x1a\x02\x18\x00")
        return self._checker

    def units(self, cps: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Escaped code points; starts, ends and documents of the units."""
        if self.prefix:  # a blank before each text that isn't empty
            some = np.flatnonzero(np.diff(offs))
            cps = np.insert(cps, offs[some], BLANK)
            offs = offs + np.concatenate([[0], np.cumsum(np.diff(offs) > 0)])
        cps = np.where(cps == 32, np.uint32(BLANK), cps)
        n = len(cps)
        if not n:
            z = np.zeros(0, np.int64)
            return cps, z, z, z
        kind = self.char_class[cps].astype(np.int64)
        start = np.ones(n, bool)
        start[1:] = ~self.together[kind[:-1] * len(self.single) + kind[1:]]
        start[offs[:-1][np.diff(offs) > 0]] = True
        s = np.flatnonzero(start)
        return cps, s, np.append(s[1:], n), np.searchsorted(offs, s, "right") - 1

    def encode(self, text: pa.Array, cache: UnitCache) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' numbers, and how many each text has."""
        cps, offs = code_points(text)
        cps, s, e, doc = self.units(cps, offs)
        ids, count = cache.lists(cache.numbers(cps, s, e, C.span_hashes(cps, s, e)))
        return ids, np.bincount(doc, count, len(offs) - 1).astype(np.int64)

    # ---------------------------------------------------------------- decoding

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[str]:
        """The texts of these pieces, count of them to each."""
        size = self.size[ids]
        piece, within = C.ragged(size)
        raw = self.flat[self.first[ids][piece] + within].tobytes()
        per = np.zeros(len(count) + 1, np.int64)
        per[1:] = np.concatenate([[0], np.cumsum(size)])[np.cumsum(count)]
        out = []
        for a, b in zip(per[:-1].tolist(), per[1:].tolist()):
            a += self.prefix and b > a and raw[a] == 32
            out.append(raw[a:b].decode("utf-8", "replace"))
        return out

    def new_cache(self) -> UnitCache:
        return UnitCache(self.encode_units)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[Vocabulary, UnitCache]:
    v = Vocabulary(path)
    return v, v.new_cache()


def encoded(docs: DataFrame, path: str = MODEL, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carried..., ids, tokens, round_trip) of every row: one scan, no shuffle."""
    keep = C.same_names(docs, "doc_id", "text", *carried)
    kinds = dict(keep.dtypes)
    schema = ", ".join(["doc_id bigint", *[f"`{c}` {kinds[c]}" for c in carried], "ids array<int>, tokens int, round_trip boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, cache = vocabulary(path)
        for batch in batches:
            for part in C.steps(batch):
                ids, count = v.encode(part.column(1), cache)
                same = pa.array([(a or "") == b for a, b in zip(part.column(1).to_pylist(), v.decode(ids, count))], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), *[part.column(2 + k) for k in range(len(carried))], C.list_column(ids, count, pa.int32()), pa.array(count.astype(np.int32)), same],
                    names=["doc_id", *carried, "ids", "tokens", "round_trip"],
                )

    return keep.mapInArrow(run, schema)


def decoded(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows with doc_id and ids; null ids give an empty text, numbers outside the vocabulary an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, _ = vocabulary(path)
        for part in batches:
            lists = part.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(v.pieces)):
                raise ValueError("a number outside the vocabulary")
            count = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(v.decode(flat, count), pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", F.expr("filter(ids, x -> x is not null)").alias("ids")).mapInArrow(run, "doc_id bigint, text string")
