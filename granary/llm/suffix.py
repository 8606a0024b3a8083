"""Substring dedup by suffix arrays: passages that occur more than once in the corpus.

Words (of the lower-cased text) are the symbols. Each shard of about ``SHARD_BYTES`` of whole documents gets its
suffix array by Larsson-Sadakane refinement: suffixes are sorted by their first word, then the groups not yet
sorted, and only those, by the rank of the suffix 1, 2, 4, ... words on, until every group is a single suffix.
Kasai's walk through the text gives the common prefixes of neighbours; many stretches of the text walk abreast.

The suffixes that start at an *anchor* can be compared across shards alone: a word is an anchor if the hash of the
three words from it is the least of some ``WINDOW`` words in a row, so equal passages have equal anchors wherever
they stand, and about one word in six is one. A ``PREFIX`` of words from an anchor is a window. In a shard, suffixes
with a common prefix of that length are neighbours and form a class; one row for each class goes to the merge,
sorted by its key, and the members that aren't first in the class are known to be repeats already. The merge
joins the shards' sorted runs two by two with binary searches; a passage that every shard has costs one row a shard.

A window is repeated if another place has the same words, ``first`` if its (doc_id, word) is the least of all.
The result doesn't depend on the shards. ``repeated_windows`` has the windows at anchors only.

``repeated_passages`` compares the suffixes at all words: every passage of ``PREFIX`` words or more that repeats is
found, to its very ends; nothing that shares fewer words in a row ever is. Windows go to the partition of the least
of some hashes of three words, which neighbouring windows mostly share, so their places travel as small differences;
what a shard knows to be a repeat travels as ranges.

Nulls and edges: null, empty and short texts have no windows; rows with a null doc_id are left out; a doc_id that
occurs twice with equal text repeats itself, both rows standing at one place; other columns are ignored; an empty
table gives no rows. A document longer than a shard is a shard of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm import common as C

SHARD_BYTES = 4 << 20
WINDOW, PREFIX, GRAM = 10, 41, 3
LANES = 2048
#: Bytes of input for each partition of the merge, and the most partitions there are.
MERGE_BYTES, MOST_PARTS = 16 << 20, 1 << 16
U64 = np.uint64


def suffix_array(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of sym, whose last symbol must be unique, and each one's place in that order."""
    n = len(sym)
    sa = np.argsort(sym, kind="stable")
    if not n:
        return sa, sa
    s = sym[sa]
    head = np.ones(n, bool)
    head[1:] = s[1:] != s[:-1]
    start = np.flatnonzero(head)
    size = np.diff(np.append(start, n))
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(start, size)
    at = np.flatnonzero(np.repeat(size > 1, size))  # places whose group isn't sorted
    h = 1
    while len(at):
        suf = sa[at]
        key = rank[suf] * n + rank[suf + h]
        o = np.argsort(key)
        suf, key = suf[o], key[o]
        sa[at] = suf
        head = np.ones(len(at), bool)
        head[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(head)
        size = np.diff(np.append(start, len(at)))
        rank[suf] = np.repeat(at[start], size)
        at = at[np.repeat(size > 1, size)]
        h *= 2
    return sa, rank


def common_prefixes(sym: np.ndarray, sa: np.ndarray, rank: np.ndarray, enough: int) -> np.ndarray:
    """For each place of sa the symbols its suffix shares with the one before it, counted up to enough."""
    n = len(sym)
    out = np.zeros(n, np.int32)
    if n < 2:
        return out
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    lanes = max(1, min(LANES, n // 64))
    edge = np.linspace(0, n, lanes + 1).astype(np.int64)
    i, end = edge[:-1].copy(), edge[1:]
    h = np.zeros(lanes, np.int64)
    while len(i):
        j = before[i]
        a, b = i + h, j + h
        more = (j >= 0) & (h < enough) & (a < n) & (b < n)
        more[more] = sym[a[more]] == sym[b[more]]
        h += more
        done = ~more
        out[rank[i[done]]] = h[done]
        h[done] = np.maximum(h[done] - 1, 0)
        i += done
        live = i < end
        if not live.all():
            i, end, h = i[live], end[live], h[live]
    return out


def _sliding(x: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    """f over x[i:i+w] for each i that has so many."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = f(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Numbers of the anchor words that have a whole window in their document; bounds: documents' first words, and the end."""
    n = len(h)
    if n < WINDOW + GRAM:
        return np.zeros(0, np.int64)
    doc_end = np.repeat(bounds[1:], np.diff(bounds))
    gram = C.span_hashes(h, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    # windows run over WINDOW words' grams, all within the document
    least = _sliding(gram, WINDOW, np.minimum)
    inside = np.arange(len(least)) + WINDOW + GRAM - 1 <= doc_end[: len(least)]
    least = np.where(inside, least, U64(0))
    # a word is an anchor if a window over it has its hash for the least
    padded = np.concatenate([np.zeros(WINDOW - 1, U64), least, np.zeros(WINDOW - 1, U64)])
    top = _sliding(padded, WINDOW, np.maximum)
    k = np.flatnonzero(top[: len(gram)] == gram)
    return k[k + PREFIX <= doc_end[k]]


def shard_rows(ids: np.ndarray, text: pa.Array, every: bool = False) -> tuple[np.ndarray, ...]:
    """Key, doc_id, word, start, end (characters) and class size of the shard's windows; size 0: known to be a repeat.

    The keys of classes ascend; those known go by their document.
    """
    raw, offs = C.text_buffer(C.lower(text))
    s, e, doc, h = C.words(raw, offs)
    docs = len(offs) - 1
    bounds = np.searchsorted(doc, np.arange(docs + 1))
    if every:
        k = np.arange(len(h))
        k = k[k + PREFIX <= np.repeat(bounds[1:], np.diff(bounds))]
    else:
        k = anchors(h, bounds)
    empty = np.zeros(0, np.int64)
    if not len(k):
        return (empty,) * (6 + every)
    chars = C.char_index(raw)
    # symbols: one of its own behind each document, below the words' ranks
    _, sym = np.unique(h, return_inverse=True)
    seq = np.insert(sym + docs, bounds[1:], np.arange(docs))
    sa, rank = suffix_array(seq)
    lcp = common_prefixes(seq, sa, rank, PREFIX)
    of_place = np.cumsum(lcp < PREFIX)
    kind = of_place[rank[k + doc[k]]]  # a window's class
    d = ids[doc[k]]
    word = k - bounds[doc[k]]
    o = np.lexsort((word, d, kind))
    k, kind, d, word = k[o], kind[o], d[o], word[o]
    first = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    size = np.zeros(len(k), np.int64)
    size[first] = np.diff(np.append(first, len(k)))
    key = np.where(size > 0, C.span_hashes(h, k, k + PREFIX), C.mix(d.view(U64))).view(np.int64)
    zero = chars[offs[doc[k]]]
    start, end = chars[s[k]] - zero, chars[e[k + PREFIX - 1]] - zero
    o = np.argsort(key, kind="stable")
    out = key[o], d[o], word[o], start[o], end[o], size[o]
    if every:
        gram = C.span_hashes(h, np.arange(len(h) - GRAM + 1), np.arange(GRAM, len(h) + 1))
        out += (C.mix(_sliding(gram, 2 * WINDOW, np.minimum)[k[o]]),)
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in C.steps(batch, size=SHARD_BYTES):
            key, d, word, start, end, size = shard_rows(part.column(0).to_numpy(), part.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(d), pa.array((word << 32) | start), pa.array((size << 32) | (end - start))], names=["key", "doc_id", "place", "extent"])


class Run:
    """Ascending keys with their least (doc_id, word) and number of places."""

    def __init__(self, key: np.ndarray, doc: np.ndarray, word: np.ndarray, size: np.ndarray) -> None:
        self.key, self.doc, self.word, self.size = key, doc, word, size

    @classmethod
    def of(cls, key: np.ndarray, doc: np.ndarray, word: np.ndarray, size: np.ndarray) -> Run:
        o = np.lexsort((word, doc, key))
        key, doc, word, size = key[o], doc[o], word[o], size[o]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        total = np.add.reduceat(size, first) if len(first) else size
        return cls(key[first], doc[first], word[first], total)

    def merged(self, other: Run) -> Run:
        """Both runs as one, other's keys found in this one's by binary search."""
        at = np.searchsorted(self.key, other.key)
        here = at < len(self.key)
        here[here] = self.key[at[here]] == other.key[here]
        a = at[here]
        doc, word, size = self.doc.copy(), self.word.copy(), self.size.copy()
        size[a] += other.size[here]
        less = (other.doc[here] < doc[a]) | ((other.doc[here] == doc[a]) & (other.word[here] < word[a]))
        doc[a[less]], word[a[less]] = other.doc[here][less], other.word[here][less]
        new = ~here
        return Run(*(np.insert(x, at[new], y[new]) for x, y in ((self.key, other.key), (doc, other.doc), (word, other.word), (size, other.size))))


def merge(runs: list[Run]) -> Run:
    while len(runs) > 1:
        runs = [runs[k].merged(runs[k + 1]) if k + 1 < len(runs) else runs[k] for k in range(0, len(runs), 2)]
    return runs[0]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, runs = [], []
    low = (1 << 32) - 1
    for batch in batches:
        key, d, place, extent = (batch.column(k).to_numpy() for k in range(4))
        start, size, length = place & low, extent >> 32, extent & low
        known = size == 0
        yield _windows(d[known], start[known], length[known], np.zeros(int(known.sum()), bool))
        key, d, place, start, size, length = (x[~known] for x in (key, d, place, start, size, length))
        if len(key):
            parts.append((key, d, place >> 32, start, length))
            runs.append(Run.of(key, d, place >> 32, size))
    if not parts:
        return
    all_ = merge(runs)
    for key, d, word, start, length in parts:
        at = np.searchsorted(all_.key, key)
        again = all_.size[at] > 1
        first = (all_.doc[at] == d) & (all_.word[at] == word)
        yield _windows(d[again], start[again], length[again], first[again])


def _windows(d: np.ndarray, start: np.ndarray, length: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(d), pa.array(start.astype(np.int32)), pa.array((start + length).astype(np.int32)), pa.array(first)], names=["doc_id", "start", "end", "first"])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, first) of every window that occurs more than once."""
    rows = C.same_names(docs, "doc_id", "text").filter("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(_shards, "key bigint, doc_id bigint, place bigint, extent bigint").repartition("key").mapInArrow(_merged, "doc_id bigint, start int, end int, first boolean")


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of int64 as differences, the bytes of equal weight together."""
    planes = [np.diff(x, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes() for x in columns]
    return zlib.compress(b"".join(planes), 1)


def _unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(columns, 8, -1)
    return [np.cumsum(np.ascontiguousarray(x.T).view(np.int64)[:, 0]) for x in planes]


def _ranges(d: np.ndarray, word: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """doc_id, start, end, first and number of the windows that start at neighbouring words, together."""
    o = np.lexsort((word, first, d))
    d, word, start, end, first = d[o], word[o], start[o], end[o], first[o]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (first[1:] != first[:-1]) | (word[1:] != word[:-1] + 1)
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(d)))
    return d[at], start[at], end[at + n - 1], first[at], n


def _range_rows(d: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(d), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(first), pa.array(n)], names=["doc_id", "start", "end", "first", "windows"])


def _every_shard(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in C.steps(batch, size=SHARD_BYTES):
                key, d, word, start, end, size, near = shard_rows(piece.column(0).to_numpy(), piece.column(1), True)
                if not len(key):
                    continue
                known = size == 0
                part = (((near >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)
                rows = []
                if known.any():
                    r = _ranges(d[known], word[known], start[known], end[known], np.zeros(int(known.sum()), bool))
                    rows.append((int(part[0]), None, _packed(r[0], r[1], r[2], r[4])))
                o = np.flatnonzero(~known)
                o = o[np.lexsort((word[o], d[o], part[o]))]
                edge = np.flatnonzero(np.concatenate([[True], part[o[1:]] != part[o[:-1]], [True]]))
                for a, b in zip(edge[:-1], edge[1:]):
                    w = o[a:b]
                    rows.append((int(part[w[0]]), key[w].tobytes(), _packed(d[w], word[w], start[w], end[w] - start[w], size[w])))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["part", "keys", "places"])
        C.give_back()

    return run


def _every_merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, runs = [], []
    for batch in batches:
        for keys, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if keys is None:
                d, start, end, n = _unpacked(places, 4)
                yield _range_rows(d, start, end, np.zeros(len(d), bool), n)
            else:
                key = np.frombuffer(keys, np.int64)
                d, word, _, _, size = _unpacked(places, 5)
                parts.append((keys, places))
                runs.append(Run.of(key, d, word, size))
    if not parts:
        return
    all_ = merge(runs)
    del runs
    for keys, places in parts:
        key = np.frombuffer(keys, np.int64)
        d, word, start, length, _ = _unpacked(places, 5)
        at = np.searchsorted(all_.key, key)
        again = all_.size[at] > 1
        first = ((all_.doc[at] == d) & (all_.word[at] == word))[again]
        yield _range_rows(*_ranges(d[again], word[again], start[again], (start + length)[again], first))
    del all_, parts
    C.give_back()


def merge_parts(docs: DataFrame) -> int:
    """Partitions of the merge: with the input's size as the plan knows it, so that a task's share of it stays the same."""
    least = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return least if size >> 60 else max(least, min(size // MERGE_BYTES, MOST_PARTS))


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, first, windows): every window of PREFIX words that repeats, wherever it starts; neighbours mostly together."""
    rows = C.same_names(docs, "doc_id", "text").filter("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    parts = merge_parts(docs)
    packed = rows.mapInArrow(_every_shard(parts), "part int, keys binary, places binary").repartitionById(parts, F.col("part"))
    return packed.mapInArrow(_every_merged, "doc_id bigint, start int, end int, first boolean, windows bigint")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, first, windows): windows that touch or overlap as one passage, apart for first and later ones."""
    order = Window.partitionBy("doc_id", "first").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = repeated_ranges(docs).repartition("doc_id").withColumn("new", (F.coalesce(F.col("start") > reach, F.lit(True))).cast("int"))
    found = found.withColumn("nth", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return found.groupBy("doc_id", "first", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("windows").alias("windows")).select("doc_id", "start", "end", "first", "windows")
