"""Token counts of whole texts under a byte-level BPE, without moving a pre-token between machines.

Two map-side tiers give the number of tokens of a pre-token. The first is a compact table (64-bit hash, length) of
the corpus's most frequent pre-tokens, broadcast once; its size is fixed by ``FREQUENT``. What it misses goes
through a cache in each Python worker, and what that misses is encoded once by the tokenizer. Pre-tokens are found
by array operations on code points that follow the tokenizer's pattern exactly; no text is split in Python.

The frequent ones are found over the whole corpus: every task keeps a bounded frequency summary of its pre-tokens
(entries below the ``SUMMARY``-th count are dropped whenever it overflows), and only the summaries are added up.
Which pre-tokens the table holds decides how fast a count is, never what it is.

Nulls and edges: a null or empty text has 0 tokens; a null doc_id is carried through; equal rows give equal rows;
other columns are ignored, whatever their names; an empty table gives no rows. A very long text is counted whole, as a step of its own; of
equally frequent pre-tokens those that sort first enter the table. Special tokens' strings in a text
are ordinary text.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common as C
from granary.llm.units import UnitCache, code_points

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of the broadcast table: 12 bytes each.
FREQUENT = 1 << 15
#: Entries of a task's frequency summary, and the count within a step from which a pre-token may enter it.
SUMMARY, LEAST = 1 << 13, 3
SPACE, LETTER, NUMBER, OTHER = range(4)


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = ord("#")
    text = points.tobytes().decode("utf-32-le")
    out = np.full(len(points), OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            out[m.start() : m.end()] = kind
    return out


def pre_tokens(cps: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the pre-tokens: the spans that PATTERN finds one after the other."""
    n = len(cps)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    kind = _classes()[cps]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # white space before something else of its document gives up its last character
    space = kind == SPACE
    last = space.copy()
    last[:-1] &= ~space[1:]
    last[-1] = False
    last &= ~edge[1:]
    start[last] = True
    # which joins what follows if it is a blank
    joins = last & (cps == 32)
    start[1:][joins[:-1]] = False
    # contractions: an apostrophe that starts a run, and one or two letters of the next
    quote = np.flatnonzero((cps == 39) & start)
    if len(quote):
        pad = np.concatenate([cps, np.zeros(2, np.uint32)])
        same = ~edge[np.minimum(quote + 1, n)]
        two = same & ~edge[np.minimum(quote + 2, n)]
        a, b = pad[quote + 1], pad[quote + 2]
        one = same & np.isin(a, [ord(c) for c in "stmd"])
        both = two & (((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108)))
        hit, size = quote[one | both], np.where(both, 2, 1)[one | both]
        start[hit + 1] = False
        after = hit + 1 + size
        start[after[after < n]] = True
    s = np.flatnonzero(start)
    return s, np.append(s[1:], n), np.searchsorted(offs, s, "right") - 1


class Lengths:
    """Tokens of pre-tokens, by both tiers."""

    def __init__(self, path: str, hashes: np.ndarray, lengths: np.ndarray) -> None:
        self.table, self.lengths = C.HashIndex(1 << max(4, int(2 * len(hashes)).bit_length())), lengths
        self.table.add(hashes)
        one = encoding(path)._core_bpe.encode_single_piece

        def make(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            return np.array([len(one(p.encode())) for p in pieces], np.int32), np.ones(len(pieces), np.int32)

        self.cache = UnitCache(make)

    def of(self, cps: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        h = C.span_hashes(cps, s, e)
        n = self.table.get(h)
        out = np.zeros(len(h), np.int64)
        out[n >= 0] = self.lengths[n[n >= 0]]
        miss = np.flatnonzero(n < 0)
        if len(miss):
            out[miss] = self.cache.lists(self.cache.numbers(cps, s[miss], e[miss], h[miss]))[0]
        return out


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, int] = {}
    for batch in batches:
        for part in C.steps(batch):
            cps, offs = code_points(part.column(part.schema.get_field_index("text")))
            s, e, _ = pre_tokens(cps, offs)
            _, at, n = np.unique(C.span_hashes(cps, s, e), return_index=True, return_counts=True)
            often = n >= LEAST
            whole = cps.tobytes().decode("utf-32-le")
            for a, b, k in zip(s[at[often]].tolist(), e[at[often]].tolist(), n[often].tolist()):
                p = whole[a:b]
                total[p] = total.get(p, 0) + k
            if len(total) > 4 * SUMMARY:
                total = _shrunk(total)
    total = _shrunk(total)
    yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], names=["piece", "n"])


def _shrunk(total: dict[str, int]) -> dict[str, int]:
    if len(total) <= SUMMARY:
        return total
    floor = sorted(total.values(), reverse=True)[SUMMARY]
    return {k: v - floor for k, v in total.items() if v > floor}


def frequent_lengths(docs: DataFrame, path: str = VOCABULARY, size: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and token counts of the most frequent pre-tokens."""
    top = C.same_names(docs, "text").mapInArrow(_summary, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    pieces = pa.array([r[0] for r in top.collect()], pa.string())  # bounded by size
    cps, offs = code_points(pieces)
    one = encoding(path)._core_bpe.encode_single_piece
    return C.span_hashes(cps, offs[:-1], offs[1:]), np.array([len(one(p.encode())) for p in pieces.to_pylist()], np.int32)


_worker: dict[str, Lengths] = {}


def token_counts(docs: DataFrame, path: str = VOCABULARY, size: int = FREQUENT) -> DataFrame:
    """(doc_id, pre_tokens, tokens) of every row: one scan, no shuffle, after the scan that fills the table."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, size))
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _worker.get(key)
        if found is None:
            _worker.clear()
            found = _worker[key] = Lengths(path, *sent.value)
        for batch in batches:
            for part in C.steps(batch):
                yield counted(part.column(0), part.column(1), found)

    return C.same_names(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, pre_tokens bigint, tokens bigint")


def counted(ids: pa.Array, text: pa.Array, lengths: Lengths) -> pa.RecordBatch:
    cps, offs = code_points(text)
    s, e, doc = pre_tokens(cps, offs)
    n = len(offs) - 1
    return pa.RecordBatch.from_arrays(
        [ids.cast(pa.int64()), pa.array(np.bincount(doc, minlength=n).astype(np.int64)), pa.array(np.bincount(doc, lengths.of(cps, s, e), n).astype(np.int64))],
        names=["doc_id", "pre_tokens", "tokens"],
    )
