"""Quality rules: gradient-boosted trees over document statistics.

Statistics are computed from the Arrow text buffers in whole-batch numpy steps. The trees are fitted here, on a
bounded sample of labelled documents (``MAX_LABELLED``, those with the least hashes of doc_id), by second-order
boosting of the logistic loss over histograms; features in ``MONOTONE`` may only raise or only lower the score:
a split that goes the other way isn't taken and child values are clipped to the middle of their parent's split.
The forest is flattened to node arrays (feature, threshold, left, right, value), and scoring walks all documents
of a batch through all trees level by level, without a Python loop over rows.

Nulls and edges: a null or empty text has zero statistics and is scored like any other; a null doc_id is scored
and carried through, it just can't have a label; equal rows get equal scores; labels with a null quality, or for
no document, are unused; of several texts with one labelled doc_id the least is fitted on; a very long text is read
whole, as a step of its own; a score that equals the bound is kept; where the labels hold fewer than two classes every document scores 1 and is kept; extra
columns are carried by the filter and ignored by the scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common as C

#: Labelled documents to fit on, at most.
MAX_LABELLED = 6000
KEEP_FROM = 0.5
TREES, DEPTH, BINS, RATE, LAMBDA, MIN_HESS = 60, 4, 48, 0.2, 1.0, 2.0

STATISTICS = (
    "chars", "words", "mean_word", "letter_share", "upper_share", "digit_share", "space_share", "symbol_share", "punctuation_share",
    "distinct_share", "top_word_share", "repeat_next_share", "repeat_line_share", "mean_line_words", "stop_share", "short_share", "ended_share", "bar_share",
)
#: +1: more can only raise the score, -1: only lower it.
MONOTONE = {"symbol_share": -1, "repeat_next_share": -1, "bar_share": -1, "upper_share": -1, "top_word_share": -1}

_CLASS = np.zeros((256, 6), np.int64)  # letter, upper, digit, space, symbol, punctuation
_CLASS[[*range(65, 91), *range(97, 123), *range(192, 256)], 0] = 1  # a lead byte counts for its character
_CLASS[range(65, 91), 1] = 1
_CLASS[range(48, 58), 2] = 1
_CLASS[[9, 10, 11, 12, 13, 32], 3] = 1
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"], 4] = 1
_CLASS[[ord(c) for c in "!\"'(),-.:;?"], 5] = 1
_STOP = "the of and a to in is that it was for on are as with be by this not from der die und das von zu den ein ist le la les de et un une des que en el los las y por con del du pour dans"


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def _group_top(doc: np.ndarray, h: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document: distinct hashes, and the count of the most frequent."""
    if not len(h):
        return np.zeros(docs), np.zeros(docs)
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    d, k = doc[order], h[order]
    start = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]))
    count = np.diff(np.concatenate([start, [len(d)]]))
    top = np.zeros(docs, np.int64)
    np.maximum.at(top, d[start], count)
    return np.bincount(d[start], minlength=docs).astype(float), top.astype(float)


def statistics(column: pa.Array) -> np.ndarray:
    """STATISTICS of each text, as [documents, statistics]."""
    raw, offs = C.text_buffer(column)
    docs = len(offs) - 1
    size = np.diff(offs)
    some = np.flatnonzero(size)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        out = np.zeros(docs)
        if len(some):
            out[some] = np.add.reduceat(flags, offs[some], dtype=np.int64)
        return out

    letter, upper, digit, space, symbol, mark = (per_doc(_CLASS[:, k].astype(np.uint8)[raw]) for k in range(6))
    chars = per_doc(((raw & 0xC0) != 0x80).view(np.uint8))
    ts, te, td, th = C.tokens(raw, offs)
    words = np.bincount(td, minlength=docs).astype(float)
    distinct, top = _group_top(td, th, docs)
    again = np.zeros(docs)
    if len(th) > 1:
        same = (th[1:] == th[:-1]) & (td[1:] == td[:-1])
        again = np.bincount(td[1:][same], minlength=docs).astype(float)
    ls, le, ld = C.runs(raw != 10, offs)
    lines = np.bincount(ld, minlength=docs).astype(float)
    kinds, _ = _group_top(ld, C.span_hashes(raw, ls, le), docs)
    ended = np.bincount(ld[np.isin(raw[le - 1], [33, 46, 63])] if len(le) else ld, minlength=docs)
    ws, we, wd, wh = C.words(raw, offs)
    stop = np.bincount(wd[np.isin(wh, _stop_hashes())], minlength=docs)
    short = np.bincount(td[(te - ts) <= 2], minlength=docs)
    bar = per_doc((raw == 124).view(np.uint8))
    return np.column_stack([
        chars, words, _ratio(chars - space, words), _ratio(letter, chars), _ratio(upper, letter), _ratio(digit, chars), _ratio(space, chars), _ratio(symbol, chars), _ratio(mark, chars),
        _ratio(distinct, words), _ratio(top, words), _ratio(again, words), 1 - _ratio(kinds, lines), _ratio(words, lines), _ratio(stop, words), _ratio(short, words), _ratio(ended, lines), _ratio(bar, words),
    ])


def _stop_hashes() -> np.ndarray:
    raw, offs = C.text_buffer(pa.array([_STOP]))
    return C.words(raw, offs)[3]


@dataclass
class Forest:
    """Trees flattened into node arrays; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[str, int] = MONOTONE, names: tuple[str, ...] = STATISTICS, trees: int = TREES, depth: int = DEPTH) -> Forest:
    n, f = x.shape
    sign = np.array([monotone.get(k, 0) for k in names])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
    binned = np.column_stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(f)])
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots, margin = [], np.full(n, base)

    def leaf(value: float) -> int:
        k = len(nodes)
        nodes.append([0, np.inf, k, k, value])
        return k

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = grad[rows], hess[rows]
        mine = float(np.clip(-g.sum() / (h.sum() + LAMBDA), low, high))
        if level == depth or len(rows) < 8:
            return leaf(mine * RATE)
        best = (1e-6, None)
        for j in range(f):
            k = len(cuts[j]) + 1
            gl = np.cumsum(np.bincount(binned[rows, j], g, k))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, j], h, k))[:-1]
            gr, hr = g.sum() - gl, h.sum() - hl
            vl, vr = -gl / (hl + LAMBDA), -gr / (hr + LAMBDA)
            gain = gl**2 / (hl + LAMBDA) + gr**2 / (hr + LAMBDA) - g.sum() ** 2 / (h.sum() + LAMBDA)
            gain[(hl < MIN_HESS) | (hr < MIN_HESS)] = -1
            if sign[j]:
                gain[(vr - vl) * sign[j] < 0] = -1
            if len(gain) and gain.max() > best[0]:
                b = int(gain.argmax())
                best = (gain[b], (j, b, float(vl[b]), float(vr[b])))
        if best[1] is None:
            return leaf(mine * RATE)
        j, b, vl, vr = best[1]
        k = len(nodes)
        nodes.append([j, cuts[j][b], 0, 0, 0.0])
        go = binned[rows, j] <= b
        middle = float(np.clip((vl + vr) / 2, low, high))
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(sign[j])]
        nodes[k][2] = grow(rows[go], level + 1, *bounds[0])
        nodes[k][3] = grow(rows[~go], level + 1, *bounds[1])
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
        a = np.array(nodes)
        one = Forest(np.array([roots[-1]]), a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], 0.0, depth)
        margin = margin + one.margin(x)
    a = np.array(nodes)
    return Forest(np.array(roots), a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], base, depth)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled documents, those of least hash: the same in every run."""
    some = C.same_names(labels, "doc_id", label).filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    some = some.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(bound)
    found = C.same_names(docs, "doc_id", "text").join(F.broadcast(some), "doc_id")  # the bound is the check of its size
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def fitted(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> Forest | None:
    found = labelled_sample(docs, labels, "quality", bound).mapInArrow(_label_rows, "doc_id bigint, label int, x array<double>").toArrow()
    if not found.num_rows:
        return None
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    y = found["label"].to_numpy()[order].astype(float)
    if y.min() == y.max():
        return None
    return fit(np.array(found["x"].to_pylist())[order], y)


def _label_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in C.steps(batch):
            x = statistics(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(2).cast(pa.int32()), C.list_column(x.reshape(-1), np.full(len(x), x.shape[1]), pa.float64())], names=["doc_id", "label", "x"])


def scores(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """(doc_id, quality, and all STATISTICS) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.steps(batch):
                x = statistics(part.column(1))
                q = forest.score(x) if forest else np.ones(len(x))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(q), *[pa.array(x[:, k]) for k in range(x.shape[1])]], names=["doc_id", "quality", *STATISTICS])

    return C.same_names(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, quality double, " + ", ".join(f"{s} double" for s in STATISTICS))


def accepted(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Scores and statistics of the documents that the rules keep."""
    return scores(docs, fitted(docs, labels)).filter(F.col("quality") >= keep_from)


def keep_good(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """docs without those that the rules reject: rows and columns pass through one Arrow step, without a shuffle."""
    forest = fitted(docs, labels)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in C.slices(batch, place):
                q = forest.score(statistics(k.column(place))) if forest else np.ones(k.num_rows)
                yield k.filter(pa.array(q >= keep_from))

    return docs.mapInArrow(run, docs.schema)
