"""Boosted trees, toxic spans and personal data: exactness of the recursions, and held-out accuracy."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import pii, quality, toxicity
from tests.llm.pii_lines import LINES


@pytest.fixture(scope="module")
def labelled(spark):
    import os

    from tests.conftest import TESTDATA

    sf = f"{TESTDATA}/sf0.01"
    if not os.path.exists(sf):
        pytest.skip("no sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").orderBy("doc_id").toPandas()


# ---------------------------------------------------------------- op1


def test_statistics_by_hand():
    x = dict(zip(quality.STATISTICS, quality.statistics(pa.array(["The cat | the CAT!\nThe cat | the CAT!\nÉté 12."]))[0]))
    assert x["chars"] == 45 and x["words"] == 12 and x["bar_share"] == 2 / 12 and abs(x["repeat_line_share"] - 1 / 3) < 1e-9 and x["ended_share"] == 1.0
    assert (quality.statistics(pa.array([None, ""], pa.string())) [:, :2] == 0).all()


def plain_statistics(t):
    """quality.statistics of one text, by string methods alone."""
    share = lambda a, b: a / b if b else 0.0
    count = lambda f: sum(1 for c in t if f(c))
    blanks = "".join(chr(k) for k in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32))
    toks = re.split(f"[{blanks}]+", t.strip(blanks)) if t.strip(blanks) else []
    lines = [x for x in t.split("\n") if x]
    chars, letters = len(t), count(lambda c: c.isascii() and c.isalpha() or ord(c) > 127)
    plain = [w for w in re.split(r"[^0-9A-Za-z_\x80-\U0010ffff]+", t) if w]
    space = count(lambda c: c in "\t\n\v\f\r ")
    top = max((toks.count(w) for w in set(toks)), default=0)
    return [
        chars, len(toks), share(chars - space, len(toks)), share(letters, chars), share(count(lambda c: "A" <= c <= "Z"), letters), share(count(lambda c: c in "0123456789"), chars), share(space, chars),
        share(count(lambda c: c in "#$%&*+/<=>@[\\]^_`{|}~"), chars), share(count(lambda c: c in "!\"'(),-.:;?"), chars), share(len(set(toks)), len(toks)), share(top, len(toks)), share(sum(a == b for a, b in zip(toks, toks[1:])), len(toks)),
        1 - share(len(set(lines)), len(lines)), share(len(toks), len(lines)), share(sum(w in quality._STOP.split() for w in plain), len(toks)), share(sum(len(w.encode()) <= 2 for w in toks), len(toks)), share(sum(x[-1] in ".!?" for x in lines), len(lines)), share(t.count("|"), len(toks)),
    ]


def plain_forest(x, y, sign, trees, depth, bins=quality.BINS):
    """Boosted trees by trying every split of every feature on the rows themselves; returns the margin of a row."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin, grown = [base] * len(y), []

    def grow(rows, level, low, high):
        total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
        leaf = ("leaf", min(max(-total_g / (total_h + quality.LAMBDA), low), high) * quality.RATE)
        if level == depth or len(rows) < 8:
            return leaf
        best = (1e-6, None)
        for j in range(x.shape[1]):
            for c in cuts[j]:
                left = [i for i in rows if x[i, j] <= c]
                gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                gr, hr = total_g - gl, total_h - hl
                vl, vr = -gl / (hl + quality.LAMBDA), -gr / (hr + quality.LAMBDA)
                gain = gl**2 / (hl + quality.LAMBDA) + gr**2 / (hr + quality.LAMBDA) - total_g**2 / (total_h + quality.LAMBDA)
                if min(hl, hr) >= quality.MIN_HESS and (vr - vl) * sign[j] >= 0 and gain > best[0] + 1e-12:
                    best = (gain, (j, c, vl, vr))
        if best[1] is None:
            return leaf
        j, c, vl, vr = best[1]
        mid = min(max((vl + vr) / 2, low), high)
        down, up = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[sign[j]]
        return (j, c, grow([i for i in rows if x[i, j] <= c], level + 1, *down), grow([i for i in rows if x[i, j] > c], level + 1, *up))

    def walk(row, node):
        while node[0] != "leaf":
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node[1]

    for _ in range(trees):
        p = [1 / (1 + np.exp(-m)) for m in margin]
        g, h = [a - b for a, b in zip(p, y)], [max(a * (1 - a), 1e-6) for a in p]
        grown.append(grow(list(range(len(y))), 0, -np.inf, np.inf))
        margin = [m + walk(r, grown[-1]) for m, r in zip(margin, x)]
    return lambda row: base + sum(walk(row, t) for t in grown)


def test_fit_against_trying_every_split():
    rng = np.random.default_rng(3)
    x = np.round(rng.random((90, 3)), 2)
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=90) > 0).astype(float)
    for sign in ((0, 0, 0), (1, -1, 0), (-1, 0, 1)):
        f = quality.fit(x, y, dict(zip("abc", sign)), ("a", "b", "c"), trees=4, depth=3)
        want = plain_forest(x, y, sign, 4, 3)
        assert np.allclose(f.margin(x), [want(r) for r in x])


def test_statistics_against_string_methods(labelled):
    texts = [t for t in labelled.text if len(t) < 30_000][:250] + ["", "a", "\n\n", "é|| x\x1cY.", "The cat\nThe cat\n", " a  b "]
    got = quality.statistics(pa.array(texts))
    for t, row in zip(texts, got):
        assert np.allclose(row, plain_statistics(t)), t


def test_query_rows_against_plain_statistics_and_walk(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    forest = quality.fitted(docs, labels)

    def walk(row, node):
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        return forest.value[node]

    want = {}
    for r in docs.collect():
        row = plain_statistics(r.text)
        want[r.doc_id] = 1 / (1 + np.exp(-forest.base - sum(walk(row, root) for root in forest.roots)))
    got = {r.doc_id: r.quality for r in quality.accepted(docs, labels).collect()}
    assert got.keys() == {k for k, v in want.items() if v >= quality.KEEP_FROM}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_rows_with_one_labelled_id_stay_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {k:04}") for k in range(300)] + [(2, "good text")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert [(r.doc_id, r.text) for r in quality.labelled_sample(docs, labels, "quality", 10).orderBy("doc_id").collect()] == [(1, "text 0000"), (2, "good text")]


def test_trees_are_monotone_and_flattened_right():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * np.sin(12 * x[:, 0]) + 0.5 * x[:, 1] + 0.2 * rng.random(3000) > 0.9).astype(float)
    f = quality.fit(x, y, {"a": 1}, ("a", "b", "c"), trees=30)
    grid = np.column_stack([np.repeat(np.linspace(0, 1, 200)[None, :], 20, 0).ravel(), np.repeat(rng.random((20, 2)), 200, 0)])
    margin = f.margin(grid).reshape(20, 200)
    assert (np.diff(margin, axis=1) >= -1e-12).all()
    assert ((f.score(x) > 0.5) == y).mean() > 0.9

    def walk(row, node):
        while f.left[node] != node:
            node = f.left[node] if row[f.feature[node]] <= f.threshold[node] else f.right[node]
        return f.value[node]

    for row in x[:50]:
        assert abs(f.margin(row[None])[0] - (f.base + sum(walk(row, r) for r in f.roots))) < 1e-9


def test_quality_on_held_out_documents(labelled):
    x, y = quality.statistics(pa.array(labelled.text)), labelled.quality.to_numpy().astype(float)
    half = np.arange(len(y)) % 2 == 0
    hit = (quality.fit(x[half], y[half]).score(x[~half]) >= 0.5) == (y[~half] == 1)
    assert hit.mean() > 0.95


def test_quality_on_odd_rows(odd, odd_rows, none, no_labels, spark):
    assert quality.accepted(odd, no_labels).count() == len(odd_rows)  # without labels all are kept
    kept = quality.keep_good(odd, no_labels)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    assert quality.keep_good(none, no_labels).count() == 0
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (2, None, None), (None, 1, 1), (99, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert quality.accepted(odd, labels).count() <= len(odd_rows)
    assert toxicity.toxic_documents(odd, labels).count() <= len(odd_rows)


# ---------------------------------------------------------------- op6


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 9):
        t = rng.normal(size=(2, 2))
        active = np.sort(rng.choice(n, max(1, n // 2), replace=False))
        add = rng.normal(size=len(active)) * 2
        boost = np.zeros(n)
        boost[active] = add
        total, on = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            s, before = 0.0, None
            for k, label in enumerate(y):
                s += (t[0, label] - t[0, 0]) if k == 0 else t[before, label]
                s += boost[k] * label
                before = label
            total += np.exp(s)
            on += np.exp(s) * np.array(y)
        got = toxicity.forward_backward(t, np.zeros(len(active), np.int64), active, add, np.array([n]))
        assert np.allclose(got, (on / total)[active])


def test_toxicity_on_held_out_documents():
    rng = random.Random(4)
    bad = ["gronk", "blarf", "snivelrot"]

    def doc(toxic):
        words = ["".join(rng.choice(("ta", "ri", "mo", "ne", "su", "lo")) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(("", "ed", "!"))
        return " ".join(words)

    y = np.array([k % 3 == 0 for k in range(600)]).astype(int)
    texts = [doc(t) for t in y]
    model = toxicity.fit(pa.array(texts[:300]), y[:300])
    score, d, _, s, e, p = toxicity.tag(pa.array(texts[300:]), model)
    assert ((score >= 0.5) == (y[300:] == 1)).all()
    for k in np.flatnonzero(p >= 0.5):
        assert any(texts[300 + d[k]][s[k] : e[k]].startswith(b) for b in bad)


def test_active_words_are_all_that_have_features(labelled):
    texts = pa.array(labelled.text)
    model = toxicity.fit(texts, labelled.toxic.to_numpy())
    assert all(len(c) for c in model.cues[:1])
    raw, offs = toxicity.C.text_buffer(toxicity.C.lower(texts))
    s, e, doc, h = toxicity.C.words(raw, offs)
    f = toxicity.features(raw, s, e, doc, h)
    n = model.table.get(f.reshape(-1)).reshape(f.shape)
    n[f == 0] = -1
    has = np.flatnonzero((n >= 0).any(axis=1))
    some, add = model.active(raw, s, e, doc)
    assert some.tolist() == has.tolist() and np.allclose(add, np.where(n[has] >= 0, model.weights[n[has]], 0.0).sum(axis=1))


def test_plain_chunks_count_as_often_as_they_are():
    """One row for many equal chunks gives the model that all of them would."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(("one", "two", "three", "gronk" if k % 4 == 0 else "four")) for _ in range(rng.choice((64, 128, 150)))) for k in range(80)]
    toxic, ids = np.array([int(k % 4 == 0) for k in range(80)]), np.arange(80)
    raw, offs = toxicity.C.text_buffer(pa.array(texts))
    pure, lists = toxicity.selected(*toxicity.feature_documents(raw, offs, toxic, ids), toxicity.sizes(toxic, ids))
    table = toxicity.C.HashIndex(16)
    table.add(pure)
    rows = toxicity.training_chunks(raw, offs, toxic, ids, table, lists)
    assert sum(length * n for length, n in zip(rows[0], rows[1])) == sum(len(t.split()) for t in texts) and max(rows[1]) > 1
    spread = tuple([x for x, n in zip(column, rows[1]) for _ in range(n)] for column in rows)
    spread = (spread[0], [1] * len(spread[0]), *spread[2:])
    a, b = toxicity.trained(table, rows), toxicity.trained(table, spread)
    assert np.allclose(a.weights, b.weights) and np.allclose(a.transitions, b.transitions)


def test_query_rows_against_plain_marginals(spark, labelled):
    """toxic_documents' rows by forward-backward in plain Python over every token."""
    docs = spark.createDataFrame(labelled[["doc_id", "text"]])
    labels = spark.createDataFrame(labelled[["doc_id", "quality", "toxic"]])
    model = toxicity.fitted(docs, labels)
    got = {r.doc_id: (r.score, r.toxic_tokens, [(x.start, x.end) for x in r.spans]) for r in toxicity.tagged(docs, model).collect()}
    want, t = {}, np.exp(model.transitions)
    for doc_id, text in zip(labelled.doc_id, labelled.text):
        raw, offs = toxicity.C.text_buffer(toxicity.C.lower(pa.array([text])))
        s, e, doc, h = toxicity.C.words(raw, offs)
        f = toxicity.features(raw, s, e, doc, h)
        n = model.table.get(f.reshape(-1)).reshape(f.shape)
        n[f == 0] = -1
        boost = [np.array([1.0, np.exp(sum(model.weights[x] for x in row if x >= 0))]) for row in n]
        alpha, beta = [], [np.ones(2)]
        for k in range(len(h)):
            a = (np.exp([0.0, model.transitions[0, 1] - model.transitions[0, 0]]) if k == 0 else alpha[-1] @ t) * boost[k]
            alpha.append(a / a.sum())
        for k in range(len(h) - 1, 0, -1):
            b = t @ (boost[k] * beta[0])
            beta.insert(0, b / b.sum())
        p = [float(x[1] * y[1] / (x * y).sum()) for x, y in zip(alpha, beta)]
        score = 1 - np.prod([1 - min(q, 1 - 1e-12) for q, row in zip(p, n) if (row >= 0).any()])
        if score < toxicity.FLAG_FROM:
            continue
        chars, on = toxicity.C.char_index(raw), [k for k in range(len(h)) if p[k] >= toxicity.SPAN_FROM and (n[k] >= 0).any()]
        spans = []
        for k in on:
            if spans and spans[-1][2] == k - 1:
                spans[-1] = [spans[-1][0], int(chars[e[k]]), k]
            else:
                spans.append([int(chars[s[k]]), int(chars[e[k]]), k])
        want[doc_id] = (score, len(on), [(a, b) for a, b, _ in spans])
    assert got.keys() == want.keys() and len(got) > 10
    for k in got:
        assert abs(got[k][0] - want[k][0]) < 1e-6 and got[k][1:] == want[k][1:]


def test_table_fit_equals_local_fit(spark, labelled):
    docs = spark.createDataFrame(labelled[["doc_id", "text"]])
    labels = spark.createDataFrame(labelled[["doc_id", "quality", "toxic"]])
    a, b = toxicity.fitted(docs.repartition(3), labels), toxicity.fit(pa.array(labelled.text), labelled.toxic.to_numpy())
    t = pa.array(labelled.text)
    assert np.allclose(toxicity.tag(t, a)[0], toxicity.tag(t, b)[0], atol=0.05)
    out = toxicity.toxic_documents(docs, labels).collect()
    flagged = {r.doc_id for r in out}
    clean = set(labelled.doc_id[labelled.toxic == 0])
    assert len(flagged & clean) <= 0.02 * len(clean) and len(flagged) > 0


def test_toxicity_on_odd_rows(odd, none, no_labels):
    assert toxicity.toxic_documents(odd, no_labels).count() == 0 and toxicity.toxic_documents(none, no_labels).count() == 0


# ---------------------------------------------------------------- op3


@pytest.fixture(scope="module")
def model():
    return pii.fitted()


def test_personal_data_on_held_out_lines(model):
    rng = random.Random(12345)
    lines = [pii._line(rng) for _ in range(400)]
    d, a, b, k = pii.entities_of(pa.array([t for t, _ in lines]), model)
    got = set(zip(d.tolist(), a.tolist(), b.tolist(), k.tolist()))
    want = {(n, x, y, kind) for n, (_, found) in enumerate(lines) for x, y, kind in found}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(got)


def test_weights_are_those_of_the_fit(model):
    new = pii.fit()
    rng = random.Random(99)
    texts = pa.array([pii._line(rng)[0] for _ in range(200)] + [t for t, _ in LINES])
    assert [x.tolist() for x in pii.entities_of(texts, new)] == [x.tolist() for x in pii.entities_of(texts, model)]


def test_personal_data_on_lines_written_by_hand(model):
    d, a, b, k = pii.entities_of(pa.array([t for t, _ in LINES]), model)
    got = {(n, pii.KINDS[kind], LINES[n][0][x:y]) for n, x, y, kind in zip(d.tolist(), a.tolist(), b.tolist(), k.tolist())}
    want = {(n, *found) for n, (_, all_) in enumerate(LINES) for found in all_}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(got)


def plain_entities(text, model):
    """entities_of for one text, by a recursion over segments in plain Python."""
    out = []
    for a, b in pii.islands_of(text or ""):
        island = pii.Island(text[a:b], text[max(0, a - pii.CONTEXT) : a], text[b : b + 1])
        n, t, at = len(island.tokens), model.transitions, {}
        for span, found in zip(island.spans, island.found):
            rows = [model.weights[model.number[f]] for f in found if f in model.number]
            at.setdefault(span[1], []).append((span[0], sum(rows, np.zeros(pii.OUT))))
        best = {(0, pii.OUT): (0.0, [])}
        for j in range(1, n + 1):
            for i, score, kinds in [(j - 1, None, [pii.OUT])] + [(i, w, range(pii.OUT)) for i, w in at.get(j, [])]:
                for y in kinds:
                    for before in range(pii.OUT + 1):
                        if (i, before) in best:
                            v = best[i, before][0] + t[before, y] + (0.0 if score is None else score[y])
                            if (j, y) not in best or v > best[j, y][0] + 1e-9:
                                best[j, y] = v, best[i, before][1] + ([] if y == pii.OUT else [(a + island.tokens[i][0], a + island.tokens[j - 1][1], pii.KINDS[y])])
        top = max((v, -y) for (j, y), (v, _) in best.items() if j == n)
        out += best[n, -top[1]][1]
    return out


def test_query_rows_against_a_plain_recursion(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(-k, t) for k, (t, _) in enumerate(LINES, 1)]
    got = sorted((r.doc_id, r.start, r.end, r.kind) for r in pii.entities(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect())
    assert got == sorted((d, *found) for d, t in rows for found in plain_entities(t, model)) and len(got) > 20


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(), st.sampled_from("0123456789@.:-+() ²³١٢é")), max_size=60))
def test_personal_data_on_any_characters(text):
    d, a, b, k = pii.entities_of(pa.array([text.encode("utf-8", "replace").decode()]), pii.fitted())
    assert all(0 <= x < y <= len(text) for x, y in zip(a.tolist(), b.tolist())) and (np.diff(a) > 0).all()


def test_a_text_that_is_one_long_island(model):
    text = "7 " * 150_000 + "and 10.1.2.3" + " 7" * 1000
    d, a, b, k = pii.entities_of(pa.array([text]), model)
    assert (300_004, 300_012, 2) in set(zip(a.tolist(), b.tolist(), k.tolist()))
    short = pii.Island("1 2 3.4 5-6 " * 400, "", "")
    assert model.best(short) == model.best(short, *[short.spans, model.scores(short)])


def test_islands_on_buffers_are_those_of_the_definition():
    rng = random.Random(3)
    texts = ["".join(rng.choice("a1@ \n\t.éx ") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    raw, offs = pii.C.text_buffer(pa.array(texts))
    chars = pii.C.char_index(raw)
    s, e, doc = pii.islands(raw, offs)
    assert [(d, int(chars[x] - chars[offs[d]]), int(chars[y] - chars[offs[d]])) for x, y, d in zip(s, e, doc)] == [(k, *i) for k, t in enumerate(texts) for i in pii.islands_of(t)]


def test_best_segmentation_against_all(model):
    for text in ("a.1@b.com", "+1 (12) 3", "1.2.3.4", "7@x.io!!"):
        island = pii.Island(text, "", "")
        score, t, n = model.scores(island), model.transitions, len(island.tokens)
        spans: dict[int, list[int]] = {}
        for k, (i, _) in enumerate(island.spans):
            spans.setdefault(i, []).append(k)

        def best(i, state):
            if i == n:
                return 0.0, []
            v, rest = best(i + 1, pii.OUT)
            top = (t[state, pii.OUT] + v, rest)
            for k in spans.get(i, []):
                for y in range(pii.OUT):
                    v, rest = best(island.spans[k][1], y)
                    v += t[state, y] + score[k, y]
                    if v > top[0]:
                        top = (v, [(island.tokens[i][0], island.tokens[island.spans[k][1] - 1][1], y), *rest])
            return top

        assert model.best(island) == best(0, pii.OUT)[1]


def test_gradient_is_that_of_the_likelihood(model):
    island = pii.Island("by 1.2.3.4", "", "")
    gold = [(next(k for k, s in enumerate(island.tokens) if s[0] == 3), len(island.tokens), 2)]
    keep = model.transitions.copy()
    _, g = model.gradient(island, gold)

    def likelihood():
        gs, _ = model.gradient(island, gold)
        score, t, n = model.scores(island), model.transitions, len(island.tokens)
        alpha = np.full((n + 1, pii.OUT + 1), -np.inf)
        alpha[0, pii.OUT] = 0
        for j in range(1, n + 1):
            alpha[j, pii.OUT] = np.logaddexp.reduce(alpha[j - 1] + t[:, pii.OUT])
            for k, (i, e) in enumerate(island.spans):
                if e == j:
                    for y in range(pii.OUT):
                        alpha[j, y] = np.logaddexp(alpha[j, y], np.logaddexp.reduce(alpha[i] + t[:, y]) + score[k, y])
        z = np.logaddexp.reduce(alpha[n])
        s, state, place = 0.0, pii.OUT, 0
        for i, e, y in gold:
            for _ in range(i - place):
                s += t[state, pii.OUT]
                state = pii.OUT
            s += t[state, y] + score[island.spans.index((i, e)), y]
            state, place = y, e
        return s - z

    base = likelihood()
    for a, b in ((pii.OUT, 2), (pii.OUT, pii.OUT), (pii.OUT, 0)):
        model.transitions[a, b] += 1e-5
        assert abs((likelihood() - base) / 1e-5 - g[a, b]) < 1e-3
        model.transitions[:] = keep


def test_personal_data_on_tables(spark, odd, odd_rows, none, model):
    assert pii.entities(odd).count() == 0 and pii.entities(none).count() == 0
    same_ = pii.masked(odd)
    assert same_.columns == odd.columns and sorted(map(str, same_.collect())) == sorted(map(str, odd.collect()))
    rows = [(None, "é at the.19@mail5.example.com, now", 34, 1), (1, "from 8.196.197.208 on", 21, 2), (2, "version 3.0 of 2024", 19, 3), (3, None, None, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, kind int")
    assert {(r.doc_id, r.kind, r.start, r.end) for r in pii.entities(df).collect()} == {(None, "EMAIL", 5, 29), (1, "IP", 5, 18)}
    out = {r.doc_id: (r.text, r.n_chars, r.kind) for r in pii.masked(df).collect()}
    assert out == {None: ("é at [EMAIL], now", 17, 1), 1: ("from [IP] on", 12, 2), 2: ("version 3.0 of 2024", 19, 3), 3: (None, None, 4)}
