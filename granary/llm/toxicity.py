"""Toxic spans by a linear-chain conditional random field.

Words of the lower-cased text are the tokens, their labels are 0 or 1. A token's features are its identity, its
prefixes of ``PREFIXES`` bytes, its last ``SUFFIX`` bytes and the words before and behind it, as far as training
selected them; weights of features and transitions are fitted here by maximum likelihood. Training tokens come from a
bounded sample of labelled documents (``MAX_LABELLED`` of each class, near copies among them left out).

The labels table is by document, so tokens are labelled by evidence from elsewhere: the sample falls into two halves
by a hash of doc_id, and a word of a toxic document is labelled 1 where its identity or prefix is frequent in the
toxic documents of the *other* half and all but absent from that half's clean ones. Words of clean documents are
labelled 0. So no token's label is made of its own document, nor is it a function of the features, which the whole
sample selects; what only some documents bear out gets a small weight. All tokens of the sample count.

Forward-backward runs over whole documents; stretches of tokens without features are crossed by a closed-form power
of the 2x2 transition matrix, which is exact, so the loop is over the few tokens that have features, of all documents
of a step at once. A document's score is the probability that any of its tokens with features is toxic, taking their
marginals as independent; offending offsets are the runs of adjacent tokens with a marginal of at least ``SPAN_FROM``.

Nulls and edges: null, empty and wordless texts have no tokens, score 0 and never show; a very long text is read
whole, as a step of its own; a null doc_id is carried through (it can't be labelled); equal rows give equal results;
a score that equals the bound is flagged; a doc_id labelled twice counts as toxic if any label says so, and the least of its texts is fitted on; labels with a
null toxic, or for no document, are unused; without toxic labels nothing is flagged; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import common as C

#: Labelled documents of each class to fit on, at most.
MAX_LABELLED = 3000
PREFIXES, SUFFIX = (4, 5, 6), 4
#: Columns of features(): identity and prefixes, suffix, the word before and the word behind.
OWN, BEHIND = 1 + len(PREFIXES), 3 + len(PREFIXES)
#: Toxic documents that a feature must be in, of the whole sample and of a half, and its log odds against clean ones.
MIN_DOCS, HALF_DOCS, MIN_LOG_ODDS = 5, 3, 3.5
FLAG_FROM = SPAN_FROM = 0.5
CHUNK, ROUNDS, STEP, DECAY = 64, 120, 0.7, 0.03
U64 = np.uint64


def features(raw: np.ndarray, s: np.ndarray, e: np.ndarray, doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hashes of each word's features; 0 for a part longer than the word, and for a neighbour that isn't."""
    out = np.zeros((len(h), BEHIND + 1), U64)
    out[:, 0] = h
    for k, n in enumerate(PREFIXES, 1):
        long = e - s >= n
        out[long, k] = C.mix(C.span_hashes(raw, s[long], s[long] + n) + U64(n))
    long = e - s >= SUFFIX
    out[long, OWN] = C.mix(C.span_hashes(raw, e[long] - SUFFIX, e[long]) + U64(100))
    next_ = np.flatnonzero(doc[1:] == doc[:-1])
    out[next_ + 1, OWN + 1] = C.mix(h[next_] + U64(101))
    out[next_, BEHIND] = C.mix(h[next_ + 1] + U64(102))
    return out


def bytes_of(raw: np.ndarray, s: np.ndarray, e: np.ndarray, last: bool = False) -> np.ndarray:
    """The first (or last) four bytes of each word, as a number; a shorter word's are padded with zeros."""
    at = np.maximum(s, e - 4) if last else s
    padded = np.concatenate([raw, np.zeros(4, np.uint8)])
    out = padded[at].astype(np.uint32)
    for k in (1, 2, 3):
        out |= np.where(at + k < e, padded[at + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def _in(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


@dataclass
class Tagger:
    """Selected features with their weights, and transitions[from, to] (label 1's bias within).

    cues: for features of the word itself, of its end and of its neighbours the four bytes that every word with such a
    feature has, or every neighbour; a cheap test that few words pass.
    """

    table: C.HashIndex
    weights: np.ndarray
    transitions: np.ndarray
    cues: tuple[np.ndarray, np.ndarray, np.ndarray] = (np.zeros(0, np.uint32),) * 3

    def active(self, raw: np.ndarray, s: np.ndarray, e: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that have selected features, and what those add to label 1."""
        if not len(s) or not len(self.weights):
            return np.zeros(0, np.int64), np.zeros(0)
        head = bytes_of(raw, s, e)
        some = _in(head, self.cues[0]) | _in(bytes_of(raw, s, e, True), self.cues[1])
        beside = _in(head, self.cues[2])
        some[1:] |= beside[:-1]
        some[:-1] |= beside[1:]
        around = some.copy()  # with the neighbours of those, for their hashes
        around[1:] |= some[:-1]
        around[:-1] |= some[1:]
        at = np.flatnonzero(around)
        # words that don't follow each other in the text aren't neighbours
        apart = doc[at] * 2 + np.cumsum(np.concatenate([[0], np.diff(at) > 1])) * 2 * (int(doc[-1]) + 1) if len(at) else at
        f = features(raw, s[at], e[at], apart, C.span_hashes(raw, s[at], e[at]))[some[at]]
        n = self.table.get(f.reshape(-1)).reshape(f.shape)
        n[f == 0] = -1
        has = (n >= 0).any(axis=1)
        return np.flatnonzero(some)[has], np.where(n[has] >= 0, self.weights[n[has]], 0.0).sum(axis=1)


def forward_backward(trans: np.ndarray, doc: np.ndarray, place: np.ndarray, add: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Marginals of label 1 of the active tokens; doc, place: their document (ascending) and token number; lengths: tokens of each document."""
    if not len(doc):
        return np.zeros(0)
    m = np.exp(trans)  # m[a, b]: from a to b, b's bias within
    values, right = np.linalg.eig(m)
    left = np.linalg.inv(right)
    top = values.max()

    def power(n: np.ndarray) -> np.ndarray:
        return np.einsum("ab,nb,bc->nac", right, (values / top)[None, :] ** n[:, None], left)

    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    count = np.diff(np.concatenate([first, [len(doc)]]))
    gap = np.empty(len(doc), np.int64)  # transitions since the token before, or the start
    gap[0] = place[0]
    gap[1:] = np.where(doc[1:] == doc[:-1], place[1:] - place[:-1], place[1:])
    step = power(gap)
    boost = np.column_stack([np.ones(len(doc)), np.exp(np.minimum(add, 50.0))])
    alpha, beta = np.zeros((len(doc), 2)), np.ones((len(doc), 2))
    begin = np.exp(np.array([0.0, trans[0, 1] - trans[0, 0]]))  # the first token is as one after a clean one
    for k in range(int(count.max())):
        at = first[count > k] + k
        before = np.broadcast_to(begin, (len(at), 2)) if k == 0 else alpha[at - 1]
        a = np.einsum("na,nab->nb", before, step[at]) * boost[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    tail = power(lengths[doc[first]] - 1 - place[first + count - 1])
    for k in range(int(count.max())):
        at = (first + count - 1 - k)[count > k]
        b = tail[count > k].sum(axis=2) if k == 0 else np.einsum("nab,nb->na", step[at + 1], boost[at + 1] * beta[at + 1])
        beta[at] = b / b.sum(axis=1, keepdims=True)
    both = alpha * beta
    return both[:, 1] / both.sum(axis=1)


def signatures(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Two minima of hashed word triples of each text: near copies have at least one in common, mostly; 0 for short texts."""
    _, _, doc, h = C.words(raw, offs)
    out = np.zeros((len(offs) - 1, 2), U64)
    if len(h) < 3:
        return out
    whole = doc[2:] == doc[:-2]
    triple, of = C.mix(h[:-2] ^ C.mix(h[1:-1] ^ C.mix(h[2:])))[whole], doc[2:][whole]
    if len(of):
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        out[of[first], 0] = np.minimum.reduceat(triple, first)
        out[of[first], 1] = np.minimum.reduceat(C.mix(triple), first)
    return out


def distinct_texts(ids: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """Those ids, in ascending order, that share no signature with one before them."""
    seen: set[int] = set()
    keep = []
    for i, pair in sorted(zip(ids.tolist(), map(tuple, sig.tolist()))):
        mine = {x for x in pair if x}
        if not mine & seen:
            keep.append(i)
        seen |= mine
    return np.array(keep, np.int64)


def halves(ids: np.ndarray) -> np.ndarray:
    return (C.mix(ids.astype(np.int64).view(U64)) >> U64(63)).astype(np.int64)


def feature_documents(raw: np.ndarray, offs: np.ndarray, toxic: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features, and in how many documents each occurs: clean and toxic ones of the first half, then of the second."""
    s, e, doc, h = C.words(raw, offs)
    if not len(h):
        return h, np.zeros((0, 4), np.int64)
    f = features(raw, s, e, doc, h)
    d, f = np.repeat(doc, f.shape[1]), f.reshape(-1)
    d, f = d[f != 0], f[f != 0]
    o = np.lexsort((d, f))
    d, f = d[o], f[o]
    once = np.concatenate([[True], (f[1:] != f[:-1]) | (d[1:] != d[:-1])])
    d, f = d[once], f[once]
    first = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
    kind = 2 * halves(ids)[d] + (toxic[d] == 1)
    return f[first], np.column_stack([np.add.reduceat((kind == k).astype(np.int64), first) for k in range(4)])


def sizes(toxic: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Numbers of clean and toxic documents of the first half, then of the second."""
    return np.bincount(2 * halves(ids) + (toxic == 1), minlength=4)


def chosen(f: np.ndarray, in_bad: np.ndarray, in_good: np.ndarray, bad: int, good: int, least: int) -> np.ndarray:
    odds = np.log((in_bad + 0.5) / (bad + 1)) - np.log((in_good + 0.5) / (good + 1))
    return np.sort(f[(in_bad >= min(least, max(1, bad // 2))) & (odds >= MIN_LOG_ODDS)])


def selected(f: np.ndarray, n: np.ndarray, all_: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The model's features, and for documents of each half the list that their words are labelled by."""
    lists = [chosen(f, n[:, k + 1], n[:, k], all_[k + 1], all_[k], HALF_DOCS) for k in (2, 0)]
    return chosen(f, n[:, 1] + n[:, 3], n[:, 0] + n[:, 2], all_[1] + all_[3], all_[0] + all_[2], MIN_DOCS), lists


def training_chunks(raw: np.ndarray, offs: np.ndarray, toxic: np.ndarray, ids: np.ndarray, table: C.HashIndex, lists: list[np.ndarray]) -> tuple[list, ...]:
    """Chunks of CHUNK tokens: length, number of such chunks, and of their tokens with features or label 1 place, label, feature numbers and cues.

    Chunks without such tokens differ in nothing but their length, so one row stands for all of a length.
    """
    s, e, doc, h = C.words(raw, offs)
    out: tuple[list, ...] = ([], [], [], [], [], [])
    if not len(h):
        return out
    f = features(raw, s, e, doc, h)
    n = table.get(f.reshape(-1)).reshape(f.shape)
    n[f == 0] = -1
    has = n >= 0
    bad = np.zeros(len(h), bool)
    for k in (0, 1):
        of = np.flatnonzero((toxic[doc] == 1) & (halves(ids)[doc] == k))
        bad[of] = _in(f[of, :OWN].reshape(-1), lists[k]).reshape(-1, OWN).any(axis=1)
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    start = np.flatnonzero(place % CHUNK == 0)
    end = np.append(start[1:], len(doc))
    says = has.any(axis=1) | bad
    some = np.add.reduceat(says.astype(np.int64), start) > 0
    head, tail = bytes_of(raw, s, e).astype(np.int64), bytes_of(raw, s, e, True).astype(np.int64)
    for a, b in zip(start[some].tolist(), end[some].tolist()):
        k = a + np.flatnonzero(says[a:b])
        cues = {int(head[x]) for x in k[has[k, :OWN].any(axis=1)]} | {1 << 32 | int(tail[x]) for x in k[has[k, OWN]]}
        cues |= {2 << 32 | int(head[x - 1]) for x in k[has[k, OWN + 1]]} | {2 << 32 | int(head[x + 1]) for x in k[has[k, BEHIND]]}
        for column, value in zip(out, (b - a, 1, (k - a).tolist(), bad[k].astype(int).tolist(), n[k].reshape(-1).tolist(), sorted(cues))):
            column.append(value)
    lengths, times = np.unique((end - start)[~some], return_counts=True)
    for length, n_of in zip(lengths.tolist(), times.tolist()):
        for column, value in zip(out, (length, n_of, [], [], [], [])):
            column.append(value)
    return out


def trained(table: C.HashIndex, chunks: tuple[list, ...]) -> Tagger:
    """Maximum likelihood, by gradient steps of adaptive size over all chunks."""
    length, times, places, labels, numbers, cues = chunks
    times = np.array(times, float)
    count = np.array([len(p) for p in places])
    row = np.repeat(np.arange(len(length)), count)
    col = np.array([x for p in places for x in p], np.int64)
    y = np.array([x for p in labels for x in p], np.int64)
    ids = np.array([x for p in numbers for x in p], np.int64).reshape(len(col), -1)
    shape = (len(length), CHUNK)
    real = np.arange(CHUNK)[None, :] < np.array(length)[:, None]
    label = np.zeros(shape, np.int64)
    label[row, col] = y
    w, t = np.zeros(table.n), np.zeros((2, 2))
    scale_w, scale_t = np.full(table.n, 1e-6), np.full((2, 2), 1e-6)
    seen = np.zeros((2, 2))
    inner = real[:, 1:]
    np.add.at(seen, (label[:, :-1][inner], label[:, 1:][inner]), np.broadcast_to(times[:, None], inner.shape)[inner])
    total = (real.sum(axis=1) * times).sum()
    for _ in range(ROUNDS):
        add = np.zeros(shape)
        add[row, col] = np.where(ids >= 0, w[ids], 0.0).sum(axis=1)
        p1, pairs = _dense(t, add, real, times)
        miss = y - p1[row, col]
        gw = (np.bincount(ids[ids >= 0], np.broadcast_to(miss[:, None], ids.shape)[ids >= 0], len(w)) - DECAY * w) / total * 100
        gt = (seen - pairs - DECAY * t) / total * 100
        scale_w += gw**2
        scale_t += gt**2
        w += STEP * gw / np.sqrt(scale_w)
        t += STEP * gt / np.sqrt(scale_t)
    found = np.unique(np.array([x for p in cues for x in p], np.int64))
    return Tagger(table, w, t, tuple((found[found >> 32 == k] & 0xFFFFFFFF).astype(np.uint32) for k in range(3)))


def nothing() -> Tagger:
    return Tagger(C.HashIndex(16), np.zeros(0), np.zeros((2, 2)))


def fit(texts: pa.Array, toxic: np.ndarray) -> Tagger:
    """The model of labelled texts in one process; fitted() does the same on a table."""
    raw, offs = C.text_buffer(C.lower(texts))
    ids = np.arange(len(toxic))
    keep = distinct_texts(ids, signatures(raw, offs))
    texts, toxic, ids = texts.take(pa.array(keep)), toxic[keep], ids[keep]
    raw, offs = C.text_buffer(C.lower(texts))
    all_ = sizes(toxic, ids)
    if not all_[1] + all_[3] or not all_[0] + all_[2]:
        return nothing()
    pure, lists = selected(*feature_documents(raw, offs, toxic, ids), all_)
    if not len(pure):
        return nothing()
    table = C.HashIndex(16)
    table.add(pure)
    return trained(table, training_chunks(raw, offs, toxic, ids, table, lists))


def _dense(t: np.ndarray, add: np.ndarray, real: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of label 1 and expected transitions of padded sequences, each of which occurs so many times."""
    n, size = add.shape
    m = np.exp(t)
    boost = np.stack([np.ones(add.shape), np.exp(np.minimum(add, 50.0))], axis=2)
    boost[~real] = 1
    alpha, beta = np.zeros((n, size, 2)), np.ones((n, size, 2))
    a = np.exp(np.array([0.0, t[0, 1] - t[0, 0]])) * boost[:, 0]
    alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
    for k in range(1, size):
        a = (alpha[:, k - 1] @ m) * boost[:, k]
        alpha[:, k] = np.where(real[:, k, None], a / a.sum(axis=1, keepdims=True), alpha[:, k - 1])
    pairs = np.zeros((2, 2))
    for k in range(size - 2, -1, -1):
        nxt = boost[:, k + 1] * beta[:, k + 1]
        go = real[:, k + 1]
        joint = alpha[go, k, :, None] * m[None] * nxt[go, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True) * times[go, None, None]).sum(axis=0)
        b = nxt @ m.T
        beta[:, k] = np.where(go[:, None], b / b.sum(axis=1, keepdims=True), 1.0)
    both = alpha * beta
    return both[:, :, 1] / both.sum(axis=2) * real, pairs


def fitted(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> Tagger:
    """The model of at most bound labelled documents of each class; texts stay with the executors."""
    some = C.same_names(labels, "doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id", F.lit(13)), "doc_id"]
    picked = some.filter("toxic = 1").orderBy(*order).limit(bound).union(some.filter("toxic = 0").orderBy(*order).limit(bound))
    rows = C.same_names(docs, "doc_id", "text").join(F.broadcast(picked), "doc_id")  # the bound is the check of its size
    sample = C.written(rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic"))

    def over(f, schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in C.steps(batch):
                    yield f(part.column(0).to_numpy(), *C.text_buffer(C.lower(part.column(1))), part.column(2).to_numpy())

        return sample.mapInArrow(run, schema)

    def signed(ids, raw, offs, toxic):
        sig = signatures(raw, offs).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(toxic), pa.array(sig[:, 0]), pa.array(sig[:, 1])], names=["doc_id", "toxic", "a", "b"])

    known = over(signed, "doc_id bigint, toxic int, a bigint, b bigint").toArrow()
    ids = known["doc_id"].to_numpy()
    keep = distinct_texts(ids, np.column_stack([known["a"].to_numpy(), known["b"].to_numpy()]).astype(np.int64)) if len(ids) else ids
    on = np.isin(ids, keep)
    all_ = sizes(known["toxic"].to_numpy()[on], ids[on])
    if not all_[1] + all_[3] or not all_[0] + all_[2]:
        return nothing()

    def kept(ids, raw, offs, toxic):
        on = np.flatnonzero(np.isin(ids, keep))
        lengths = np.diff(offs)[on]
        row, within = C.ragged(lengths)
        return raw[offs[on][row] + within], np.concatenate([[0], np.cumsum(lengths)]), toxic[on], ids[on]

    def counted(*batch):
        f, n = feature_documents(*kept(*batch))
        return pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), *[pa.array(n[:, k]) for k in range(4)]], names=["f", *_FOUR])

    def likely(bad: str, good: str, of_bad: int, of_good: int) -> Column:  # what chosen() takes, and a little more
        return F.expr(f"({bad} + 0.5) / {of_bad + 1} >= {0.99 * np.exp(MIN_LOG_ODDS)} * ({good} + 0.5) / {of_good + 1}")

    sums = over(counted, f"f bigint, {' bigint, '.join(_FOUR)} bigint").groupBy("f").agg(*[F.sum(c).alias(c) for c in _FOUR])
    some = likely("(n1 + n3)", "(n0 + n2)", all_[1] + all_[3], all_[0] + all_[2]) | likely("n1", "n0", all_[1], all_[0]) | likely("n3", "n2", all_[3], all_[2])
    counts = sums.filter(F.expr(f"n1 + n3 >= {min(HALF_DOCS, max(1, int(min(all_[1], all_[3])) // 2))}")).filter(some).toArrow()
    pure, lists = selected(counts["f"].to_numpy().view(U64), np.column_stack([counts[c].to_numpy() for c in _FOUR]), all_)
    if not len(pure):
        return nothing()
    table = C.HashIndex(16)
    table.add(pure)

    def cut_up(*batch):
        found = training_chunks(*kept(*batch), table, lists)
        return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int32()) for x in found[:2]], *[pa.array(x, pa.list_(pa.int64())) for x in found[2:]]], names=_CHUNK)

    schema = f"length int, times int, {', '.join(f'{c} array<bigint>' for c in _CHUNK[2:])}"
    chunks = over(cut_up, schema).groupBy("length", *_CHUNK[2:]).agg(F.sum("times").alias("times")).orderBy("length", *_CHUNK[2:]).toArrow()
    return trained(table, tuple(chunks[c].to_pylist() for c in _CHUNK))


_FOUR = ["n0", "n1", "n2", "n3"]
_CHUNK = ["length", "times", "places", "labels", "numbers", "cues"]


def tag(column: pa.Array, model: Tagger) -> tuple[np.ndarray, ...]:
    """Documents' scores; and of tokens with features: document, token number, start, end (characters), marginal."""
    raw, offs = C.text_buffer(C.lower(column))  # a character's lower case is one character: offsets hold
    s, e, doc = C.runs(C._WORD[raw], offs)
    lengths = np.bincount(doc, minlength=len(offs) - 1)
    some, add = model.active(raw, s, e, doc)
    d = doc[some]
    first = np.searchsorted(doc, np.arange(len(offs) - 1))
    place = some - first[d]
    p = forward_backward(model.transitions, d, place, add, lengths)
    clean = np.zeros(len(offs) - 1)
    np.add.at(clean, d, np.log1p(-np.minimum(p, 1 - 1e-12)))
    chars = C.char_index(raw)
    return 1 - np.exp(clean), d, place, chars[s[some]] - chars[offs[d]], chars[e[some]] - chars[offs[d]], p


_OUT = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])


def toxic_documents(docs: DataFrame, labels: DataFrame, flag_from: float = FLAG_FROM) -> DataFrame:
    """(doc_id, score, toxic_tokens, spans) of the documents that score at least flag_from."""
    return tagged(docs, fitted(docs, labels), flag_from)


def tagged(docs: DataFrame, model: Tagger, flag_from: float = FLAG_FROM) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.steps(batch):
                score, d, place, s, e, p = tag(part.column(1), model)
                flagged = np.flatnonzero(score >= flag_from)
                if not len(flagged):
                    continue
                on = p >= SPAN_FROM
                d, place, s, e, p = d[on], place[on], s[on], e[on], p[on]
                if len(d):
                    new = np.concatenate([[True], (d[1:] != d[:-1]) | (place[1:] != place[:-1] + 1)])
                    head = np.flatnonzero(new)
                    last = np.concatenate([head[1:], [len(d)]]) - 1
                    sd, ss, se, sp = d[head], s[head], e[last], np.maximum.reduceat(p, head)
                else:
                    sd, ss, se, sp = d, s, e, p
                per = np.bincount(sd, minlength=len(score))[flagged]
                inside = np.isin(sd, flagged)
                spans = pa.StructArray.from_arrays([pa.array(ss[inside].astype(np.int32)), pa.array(se[inside].astype(np.int32)), pa.array(sp[inside])], fields=list(_OUT))
                offs = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(flagged)).cast(pa.int64()), pa.array(score[flagged]), pa.array(np.bincount(d, minlength=len(score))[flagged].astype(np.int32)), pa.ListArray.from_arrays(pa.array(offs), spans)],
                    names=["doc_id", "score", "toxic_tokens", "spans"],
                )

    return C.same_names(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, score double, toxic_tokens int, spans array<struct<start:int,end:int,probability:double>>")
