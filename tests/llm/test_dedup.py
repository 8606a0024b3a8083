"""Line hashing, SuperMinHash and suffix arrays against brute force."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from granary.llm import common as C
from granary.llm import components, line_dedup, near_dup, suffix


def docs_of(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ---------------------------------------------------------------- op7


def test_lines_against_sql(spark, sf, duck, same):
    same(line_dedup.removed_units(docs_of(spark, sf)), duck(line_dedup.SQL))


def test_lines_on_odd_rows(spark, odd, none, text):
    line = text(9, 30)
    more = spark.createDataFrame([(20, f"x\n{line}\ny"), (21, line.upper().replace(" ", "  ")), (22, line)], "doc_id bigint, text string")
    base = odd.select("doc_id", "text").union(more)
    got = {(r.doc_id, r.start, r.kept_doc_id, r.kept_start) for r in line_dedup.removed_units(base).collect()}
    assert got == {(21, 0, 20, 2), (22, 0, 20, 2), (5, 0, 4, 0)}  # both rows of doc 4 stand at one place
    assert line_dedup.removed_units(none).count() == 0
    out = {r.doc_id: r.text for r in line_dedup.without_units(more, line_dedup.removed_units(more)).collect()}
    assert out[20] == f"x\n{line}\ny" and out[21] == "" and out[22] == ""


def test_short_lines_and_short_texts(spark, odd):
    rows = [(1, "Subscribe to our news.\nfirst body"), (2, "another body\n  subscribe to  our news. \nand its end"), (3, "Subscribe to our news."), (4, "first body"), (5, "}\n}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    removed = line_dedup.removed_units(docs)
    assert sorted((r.doc_id, r.start, r.end, r.kept_doc_id, r.kept_start) for r in removed.collect()) == [(2, 15, 38, 1, 0), (3, 0, 22, 1, 0), (4, 0, 10, 1, 23), (5, 2, 3, 5, 0)]
    out = {r.doc_id: r.text for r in line_dedup.without_units(docs, removed).collect()}
    assert out[1] == rows[0][1] and "subscribe" not in out[2] and "another body" in out[2] and "and its end" in out[2] and out[3] == out[4] == ""


def test_passages_within_lines(spark, text):
    passage = f"{text(40, 5)}. {text(41, 12)}. {text(42, 9)}! {text(43, 14)}. {text(44, 10)}?"
    rows = [(k, f"{text(50 + k, 40)}. {passage} {text(70 + k, 40)}.") for k in range(4)] + [(9, f"{text(60, 50)}. A. B. C.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    removed = line_dedup.removed_units(docs)
    assert {r.doc_id for r in removed.collect()} == {1, 2, 3} and {r.kept_doc_id for r in removed.collect()} == {0}
    out = {r.doc_id: r.text for r in line_dedup.without_units(docs, removed).collect()}
    for k in (1, 2, 3):
        assert " ".join(out[k].split()) == f"{text(50 + k, 40)}. {text(70 + k, 40)}."
    assert out[0] == rows[0][1] and out[9] == rows[4][1]


def overlapping(rows, removed):
    """Removed units that overlap a unit that is said to be kept."""
    kept = {(r.kept_doc_id, r.kept_start, r.kept_end) for r in removed}
    return [(r, k) for r in removed for k in kept if k[0] == r.doc_id and k[1] < r.end and r.start < k[2]]


def test_what_is_kept_stays_whole(spark, text):
    line = text(1, 10)
    same_ = f"{text(2, 12)}. "
    rows = [(1, f"{line}\n{line}\n{line}"), (2, same_ * 6), (3, f"{text(3, 25)}. {same_ * 3}{text(4, 25)}."), (4, f"{text(5, 25)}. {same_ * 3}{text(4, 25)}. {text(6, 9)}.")]
    removed = line_dedup.removed_units(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.start) for r in removed if r.doc_id == 1} == {(1, len(line) + 1), (1, 2 * len(line) + 2)}
    assert not overlapping(rows, removed) and {r.doc_id for r in removed} == {1, 2, 3, 4}


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.text(alphabet="ab.! \n\tÉ", max_size=80)), min_size=1, max_size=6))
def test_any_texts_against_sql(spark, duck, same, rows):
    import pandas as pd

    rows = [(d, t.replace("a", "a b c d ")) for d, t in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2)
    removed = line_dedup.removed_units(docs)
    same(removed, duck(line_dedup.SQL, documents=pd.DataFrame(rows, columns=["doc_id", "text"])))
    if len({d for d, _ in rows}) == len(rows):
        assert not overlapping(rows, removed.collect())


# ---------------------------------------------------------------- op9


def test_superminhash_estimates_jaccard():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(1, 1 << 62, n).astype(np.uint64) for n in (300, 100, 100))
    x, y = np.concatenate([common, a]), np.concatenate([common, b])
    sig = near_dup.superminhash(np.repeat([0, 1], 400), np.concatenate([x, y]), 2, 512)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.06


def shingles(t):
    raw, offs = C.text_buffer(C.lower(pa.array([t], pa.string())))
    return set(near_dup.elements(raw, offs)[1].tolist())


def test_near_duplicates_against_brute_force(spark, sf):
    rows = [(r.doc_id, shingles(r.text)) for r in docs_of(spark, sf).collect()]
    rows = [r for r in rows if r[1]]
    want = {(a, b) for k, (a, x) in enumerate(rows) for b, y in rows[k + 1 :] if len(x & y) / len(x | y) >= near_dup.THRESHOLD}
    group = {r.doc_id: r.group_id for r in near_dup.near_duplicate_groups(docs_of(spark, sf)).collect()}
    found = {p for p in want if p[0] in group and group[p[0]] == group.get(p[1])}
    assert want and len(found) >= 0.9 * len(want)
    true = components.union_pairs(*zip(*want))
    for d, g in group.items():  # no group joins what brute force doesn't
        assert true[d] == true[g]


def test_prefix_join_is_exact(spark, sf):
    rows = [(r.doc_id, shingles(r.text)) for r in docs_of(spark, sf).collect()]
    rows = [r for r in rows if r[1]]
    for t in (0.4, near_dup.THRESHOLD, 0.8):
        want = {(min(a, b), max(a, b)) for k, (a, x) in enumerate(rows) for b, y in rows[k + 1 :] if a != b and len(x & y) / len(x | y) >= t}
        sets = spark.createDataFrame([(d, 0, len(x), [int(np.uint64(e).view(np.int64)) for e in x]) for d, x in rows], near_dup._ELEMENTS)
        got = {(r.a, r.b) for r in near_dup.prefix_pairs(sets.select("rep", sets["rep"].alias("root")), sets, t).collect()}
        assert want and want <= got and len(got) <= 3 * len(want)


def test_hot_bucket_of_boilerplate(spark, text):
    """Texts that share half their words meet in buckets of many, where only the alike ones may be joined."""
    common = text(1, 60)
    rows = [(k, f"{common} {text(100 + k, 45)}") for k in range(120)] + [(500 + k, f"{common} {text(100 + k, 44)} z") for k in range(0, 120, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sets = {d: shingles(t) for d, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= near_dup.THRESHOLD}
    true = components.union_pairs(*zip(*want))
    for fan in (2, 64):
        got = {r.doc_id: r.group_id for r in near_dup.near_duplicate_groups(docs, fan=fan).collect()}
        assert got == true


def test_one_row_of_equal_texts_is_the_same_in_every_run(spark):
    rows = [(1, "some words of a text", k) for k in range(40)] + [(2, "SOME words of a text", 0)]
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, other int").repartition(parts)
        assert [tuple(r) for r in near_dup.keep_one_of_each(df).collect()] == [(1, "some words of a text", 0)]


def test_near_duplicates_on_odd_rows(odd, odd_rows, none):
    got = {(r.doc_id, r.group_id, r.keep) for r in near_dup.near_duplicate_groups(odd).collect()}
    assert got == {(4, 4, True), (5, 4, False)}
    kept = near_dup.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and 5 not in ids and len(ids) == 7
    assert near_dup.near_duplicate_groups(none).count() == 0 and near_dup.keep_one_of_each(none).count() == 0


def test_large_group_of_copies_and_chain(spark, text):
    base = text(5, 200).split()
    rows = [(k, " ".join(base)) for k in range(500)] + [(1000 + k, " ".join(base[: 200 - 4 * k])) for k in range(1, 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = near_dup.near_duplicate_groups(df).collect()
    assert len(got) == 519 and {r.group_id for r in got} == {0} and sum(r.keep for r in got) == 1


def test_components_of_a_path(spark):
    edges = [(k + 1, k) for k in range(60)] + [(100, 101), (102, 101)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}


# ---------------------------------------------------------------- op5


def test_suffix_array_and_prefixes_against_sorting():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 60, 400):
        for k in (1, 2, 6):
            x = np.append(rng.integers(1, k + 1, n), 0)
            sa, rank = suffix.suffix_array(x)
            assert sa.tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())
            assert (rank[sa] == np.arange(len(x))).all()

            def shared(a, b):
                h = 0
                while h < 7 and max(a, b) + h < len(x) and x[a + h] == x[b + h]:
                    h += 1
                return h

            assert suffix.common_prefixes(x, sa, rank, 7).tolist() == [0] + [shared(sa[i - 1], sa[i]) for i in range(1, len(x))]


def brute_windows(rows):
    """(doc_id, start, end, first) of repeated anchor windows, by a dictionary of word tuples."""
    places = defaultdict(list)
    for d, t in rows:
        raw, offs = C.text_buffer(C.lower(pa.array([t], pa.string())))
        s, e, _, h = C.words(raw, offs)
        chars = C.char_index(raw)
        for k in suffix.anchors(h, np.array([0, len(h)])).tolist():
            words = tuple(raw[a:b].tobytes() for a, b in zip(s[k : k + suffix.PREFIX], e[k : k + suffix.PREFIX]))
            places[words].append((d, k, int(chars[s[k]]), int(chars[e[k + suffix.PREFIX - 1]])))
    return sorted((d, a, b, (d, k) == min(p)[:2]) for p in places.values() if len(p) > 1 for d, k, a, b in p)


def test_windows_against_brute_force_in_any_shards(spark, sf, monkeypatch):
    docs = docs_of(spark, sf)
    want = brute_windows([(r.doc_id, r.text) for r in docs.collect()])
    assert want
    for parts in (1, 5):
        got = sorted(tuple(r) for r in suffix.repeated_windows(docs.repartition(parts)).collect())
        assert got == want


def test_planted_passages_are_found(spark, text):
    passage = text(77, 50)
    rows = [(k, f"{text(100 + k, 90)}. {passage}\n{text(200 + k, 40)}") for k in range(6)] + [(50 + k, text(300 + k, 300)) for k in range(20)]
    got = suffix.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert {r.doc_id for r in got} == set(range(6)) and {r.doc_id for r in got if not r["first"]} == set(range(1, 6))
    sure = " ".join(passage.split()[9:-9])
    for k in range(1, 6):  # what is removed covers the passage but for a window's words at either end
        assert any(sure in dict(rows)[k][r.start : r.end] for r in got if r.doc_id == k and not r["first"])
    for r in got:
        assert len(dict(rows)[r.doc_id][r.start : r.end].split()) >= suffix.PREFIX


def brute_passages(rows):
    """repeated_passages by a dictionary of all word tuples."""
    places, spans = defaultdict(list), defaultdict(list)
    for d, t in rows:
        raw, offs = C.text_buffer(C.lower(pa.array([t], pa.string())))
        s, e, _, _ = C.words(raw, offs)
        chars = C.char_index(raw)
        said = [raw[a:b].tobytes() for a, b in zip(s, e)]
        for k in range(len(said) - suffix.PREFIX + 1):
            places[tuple(said[k : k + suffix.PREFIX])].append((d, k, int(chars[s[k]]), int(chars[e[k + suffix.PREFIX - 1]])))
    for p in places.values():
        for d, k, a, b in p if len(p) > 1 else ():
            spans[d, (d, k) == min(p)[:2]].append((a, b))
    out = []
    for (d, first), found in spans.items():
        merged = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1] = [merged[-1][0], b, merged[-1][2] + 1]
            else:
                merged.append([a, b, 1])
        out += [(d, a, b, first, n) for a, b, n in merged]
    return sorted(out)


def test_passages_against_brute_force_in_any_shards(spark, sf):
    docs = docs_of(spark, sf)
    want = brute_passages([(r.doc_id, r.text) for r in docs.collect()])
    assert want
    for parts in (1, 5):
        assert sorted(tuple(r) for r in suffix.repeated_passages(docs.repartition(parts)).collect()) == want


def test_short_passages_are_found_to_their_ends(spark, text):
    rows = []
    for n in range(40, 50):
        rows += [(2 * n + k, f"{text(100 * n + k, 60)} x{n}y{k} {text(n, n)} z{n}y{k} {text(100 * n + 50 + k, 30)}") for k in (0, 1)]
    got = {r.doc_id: r for r in suffix.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}
    assert set(got) == set(range(82, 100))
    for n in range(41, 50):
        for k in (0, 1):
            r = got[2 * n + k]
            assert dict(rows)[r.doc_id][r.start : r.end] == text(n, n) and r["first"] == (k == 0) and r.windows == n - 40


def test_suffixes_on_odd_rows(odd, none):
    got = suffix.repeated_passages(odd).collect()
    assert {(r.doc_id, r["first"]) for r in got} == {(4, True), (5, False)}
    assert suffix.repeated_passages(none).count() == 0
