"""Token counts and SentencePiece against the libraries."""

import os

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import pieces, token_counts
from granary.llm.units import UnitCache, code_points

if not os.path.exists(token_counts.VOCABULARY):
    pytest.skip("the public vocabularies aren't here", allow_module_level=True)

ODD = "abt 's 't're\n\r\t'll 'd'm  é日12٣²!?.''́😀_Ⅷ▁\x00   "
texts = st.lists(st.one_of(st.text(alphabet=ODD, max_size=40), st.text(max_size=30)), max_size=8)


def lengths(frequent=()):
    cps, offs = code_points(pa.array(list(frequent), pa.string()))
    one = token_counts.encoding(token_counts.VOCABULARY)._core_bpe.encode_single_piece
    return token_counts.Lengths(token_counts.VOCABULARY, token_counts.C.span_hashes(cps, offs[:-1], offs[1:]), np.array([len(one(p.encode())) for p in frequent], np.int32))


@settings(max_examples=150, deadline=None)
@given(texts)
def test_pre_tokens_are_those_of_the_pattern(ts):
    cps, offs = code_points(pa.array(ts, pa.string()))
    s, e, doc = token_counts.pre_tokens(cps, offs)
    whole = cps.tobytes().decode("utf-32-le")
    assert [(d, whole[a:b]) for d, a, b in zip(doc, s, e)] == [(k, m) for k, t in enumerate(ts) for m in regex.findall(token_counts.PATTERN, t)]


@settings(max_examples=60, deadline=None)
@given(texts)
def test_counts_are_the_librarys(ts):
    enc = token_counts.encoding(token_counts.VOCABULARY)
    out = token_counts.counted(pa.array(range(len(ts)), pa.int64()), pa.array(ts, pa.string()), lengths([" the", "a", "\n"]))
    assert out.column(2).to_pylist() == [len(enc.encode_ordinary(t)) for t in ts]


def test_counts_on_tables(spark, sf, odd, odd_rows, none):
    enc = token_counts.encoding(token_counts.VOCABULARY)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: len(enc.encode_ordinary(r.text)) for r in docs.collect()}
    for size in (16, token_counts.FREQUENT):  # what the table holds doesn't change a count
        assert {r.doc_id: r.tokens for r in token_counts.token_counts(docs, size=size).collect()} == want
    got = sorted((str(r.doc_id), r.tokens) for r in token_counts.token_counts(odd).collect())
    assert got == sorted((str(r[0]), len(enc.encode_ordinary(r[1] or ""))) for r in odd_rows)
    assert token_counts.token_counts(none).count() == 0


def test_copies_of_a_very_long_pre_token(spark):
    enc = token_counts.encoding(token_counts.VOCABULARY)
    t = "".join(chr(0x4E00 + 7 * k) for k in range(300))
    assert len(enc.encode_ordinary(t)) > 255
    docs = spark.createDataFrame([(k, t) for k in range(3)], "doc_id bigint, text string").coalesce(1)
    assert [(r.pre_tokens, r.tokens) for r in token_counts.token_counts(docs).collect()] == [(1, len(enc.encode_ordinary(t)))] * 3


# ---------------------------------------------------------------- op10


@settings(max_examples=60, deadline=None)
@given(texts)
def test_pieces_are_the_librarys(ts):
    v, cache = pieces.vocabulary(pieces.MODEL)
    ids, count = v.encode(pa.array(ts, pa.string()), cache)
    at = np.cumsum(count)
    want = v.library.encode(ts, num_threads=1)
    assert [ids[b - n : b].tolist() for b, n in zip(at, count)] == want
    assert not ts or v.decode(ids, count) == v.library.decode(want)


def test_heap_and_stacked_agendas_agree():
    v, _ = pieces.vocabulary(pieces.MODEL)
    for unit in ["▁international", "▁▁▁▁", "thethethethe", "▁" + "ab" * 20, "a" * 48]:
        flat, count = v.encode_units([unit])
        assert flat.tolist() == v.heap(unit)


def test_a_full_cache_starts_anew():
    v, _ = pieces.vocabulary(pieces.MODEL)
    small = UnitCache(v.encode_units, limit=3)
    for t in ["one two three four five six", "six five seven", "one"]:
        assert v.encode(pa.array([t]), small)[0].tolist() == v.library.encode(t)


def test_wrong_agenda_is_noticed():
    v = pieces.Vocabulary(pieces.MODEL)
    v.level = v.level[::-1].copy()
    with pytest.raises(AssertionError):
        v.encode(pa.array(["international understanding"]), v.new_cache())


def test_pieces_on_tables(spark, sf, odd, odd_rows, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = pieces.encoded(docs, carried=("source",))
    rows = out.collect()
    lib = pieces.vocabulary(pieces.MODEL)[0].library
    source = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    assert len(rows) == len(source) and all(r.round_trip and r.ids == lib.encode(source[r.doc_id][0]) and r.source == source[r.doc_id][1] and r.tokens == len(r.ids) for r in rows)
    assert {r.doc_id: r.text for r in pieces.decoded(out).collect()} == {k: t for k, (t, _) in source.items()}
    got = sorted((str(r.doc_id), r.ids) for r in pieces.encoded(odd).collect())
    assert got == sorted((str(r[0]), lib.encode(r[1] or "")) for r in odd_rows)
    assert pieces.encoded(none).count() == 0


def test_decoding_odd_rows(spark, none):
    rows = [(1, None), (2, []), (None, [5, None, 7]), (3, [9])]
    df = spark.createDataFrame(rows, "doc_id bigint, ids array<int>")
    lib = pieces.vocabulary(pieces.MODEL)[0].library
    assert {r.doc_id: r.text for r in pieces.decoded(df).collect()} == {1: "", 2: "", None: lib.decode([5, 7]), 3: lib.decode([9])}
    assert pieces.decoded(df.limit(0)).count() == 0


def test_texts_made_up_to_collide_are_told_apart():
    """Thue-Morse strings and their complements have one polynomial hash modulo 2**64, whatever its base."""
    n = 1 << 12
    bits = np.array([bin(k).count("1") & 1 for k in range(n)])
    a, b = "".join("xy"[k] for k in bits), "".join("yx"[k] for k in bits)
    for text in ([a, b], [f"{a} {b}"]):
        cps, offs = code_points(pa.array(text))
        s, e, _ = token_counts.pre_tokens(cps, offs)
        h = token_counts.C.span_hashes(cps, s, e)
        assert len(h) == 2 and h[0] != h[1]
    v, cache = pieces.vocabulary(pieces.MODEL)
    ids, count = v.encode(pa.array([a, b]), cache)
    assert v.decode(ids, count) == [a, b]


@pytest.mark.parametrize("text", ["x" * 1_000_000, "wort " * 200_000, "\u4e2d\u6587" * 150_000, "a\n" * 300_000])
def test_very_long_texts(text):
    from granary.llm import line_dedup, near_dup, pii, quality, suffix, toxicity

    column, ids = pa.array([text, None, ""]), pa.array([1, 2, 3], pa.int64())
    enc = token_counts.encoding(token_counts.VOCABULARY)
    got = token_counts.counted(ids, column, lengths())
    if len(set(text)) > 1:  # the library itself needs quadratic time for one long run of a letter
        assert got.column(2).to_pylist() == [len(enc.encode_ordinary(text)), 0, 0]
    assert line_dedup.units_of(ids, column).num_rows >= 1
    assert len(near_dup._sets_of(pa.RecordBatch.from_arrays([ids, column], names=["doc_id", "text"]))[0]) == 1
    assert len(pii.entities_of(column, pii.fitted())[0]) == 0
    assert quality.statistics(column).shape == (3, 18)
    assert len(suffix.shard_rows(ids.to_numpy(), column, True)) == 7
    assert toxicity.tag(column, toxicity.nothing())[0].tolist() == [0.0, 0.0, 0.0]
