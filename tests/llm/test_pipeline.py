"""The pipeline: each stage does its work on all its predecessor kept."""

import collections

import corpus_pipeline as P
from granary.llm import mixing, near_dup, pieces, pii, quality


def test_stages_in_order():
    assert [f.__name__ for _, f in P.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "source_mix", "encoding"]


def test_stages_against_operators(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = P.quality_rules(spark, docs, sf)
    kept = {r.doc_id for r in quality.accepted(docs, labels).select("doc_id").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept and len(kept) < docs.count()
    single = P.near_duplicates(spark, good, sf)
    gone = {r.doc_id for r in near_dup.near_duplicate_groups(good).collect() if not r.keep}
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == kept - gone
    clean = P.personal_data(spark, single, sf)
    found = {r.doc_id for r in pii.entities(single).select("doc_id").collect()}
    before, after = ({r.doc_id: r for r in x.collect()} for x in (single, clean))
    assert clean.columns == docs.columns and before.keys() == after.keys()
    assert {k for k in before if before[k].text != after[k].text} == found
    assert all(after[k].n_chars == len(after[k].text) for k in found) and pii.entities(clean).count() == 0
    mixed = P.source_mix(spark, clean, sf)
    assert mixed.columns == docs.columns
    counts = collections.Counter(r.doc_id for r in mixed.collect())
    assert counts == collections.Counter(r.doc_id for r in mixing.replicate(clean).collect())


def test_run(spark, sf):
    rows = P.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    step = docs
    for _, f in P.STAGES[:-1]:
        step = f(spark, step, sf).cache()
    lib = pieces.vocabulary(pieces.MODEL)[0].library
    want = sorted((r.doc_id, r.source, lib.encode(r.text)) for r in step.collect())
    assert sorted((r.doc_id, r.source, r.ids) for r in rows) == want and all(r.round_trip for r in rows)


def test_empty_tables(spark, none, sf):
    step = none
    for name, f in P.STAGES:
        step = f(spark, step, sf)
        assert step.count() == 0 and (name == "encoding" or step.columns == none.columns)


def test_odd_rows_and_clashing_columns(spark, odd, odd_rows, sf, tmp_path):
    """Nulls, empties, a very long text, ties, repeated rows and columns named as the operators' own."""
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    step, seen = odd, {}
    for name, f in P.STAGES[:-1]:
        step = f(spark, step, str(tmp_path)).cache()
        assert step.columns == odd.columns
        seen[name] = step.collect()
    assert len(seen["quality"]) == len(odd_rows)  # without labels all pass
    ids = collections.Counter(r.doc_id for r in seen["near_duplicates"])
    assert ids == {None: 1, 1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 7: 1}  # 4 once, of two equal rows and the copy 5
    text = {r[0]: r[1] for r in odd_rows}
    assert all(r.text == text[r.doc_id] for r in seen["personal_data"])
    assert {r.doc_id for r in seen["mixing"]} <= ids.keys() and all(r.copy == 2 for r in seen["mixing"])  # the input's own column
    last = P.STAGES[-1][1](spark, step, str(tmp_path)).collect()
    lib = pieces.vocabulary(pieces.MODEL)[0].library
    assert sorted((str(r.doc_id), r.ids) for r in last) == sorted((str(r.doc_id), lib.encode(r.text or "")) for r in seen["mixing"])


def test_run_leaves_only_its_last_stage_behind(spark, sf):
    import glob
    import os

    from granary.lineage import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    P.run(spark, sf).count()
    left = set(os.listdir(folder)) - before
    assert [k for k in left if k.startswith("granary-")] == []
    new = [k for k in left if k.startswith("pipeline-")]
    assert len(new) == 1 and [os.path.basename(k) for k in glob.glob(f"{folder}/{new[0]}/*")] == ["mixing"]
