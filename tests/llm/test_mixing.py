"""Poisson replication: counts, rates and odd rows."""

import pandas as pd

from granary.llm import mixing


def test_against_sql(spark, sf, duck, same):
    same(mixing.replicate(spark.read.parquet(f"{sf}/documents.parquet")), duck(mixing.SQL))


def test_rates_follow_the_weights(spark):
    rows = [(k, f"t{k}", "big" if k % 10 else "small") for k in range(20_000)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
    n = {r["source"]: r["count"] for r in mixing.replicate(df, {"big": 1, "small": 3}).groupBy("source").count().collect()}
    assert abs(n["small"] / 15_000 - 1) < 0.05 and abs(n["big"] / 5_000 - 1) < 0.08
    assert "big" not in {r.source for r in mixing.replicate(df, {"big": 0, "small": 1}).select("source").distinct().collect()}


def test_high_rates_are_not_cut(spark):
    df = spark.createDataFrame([(1, "x", "rare")] + [(k, "y", "big") for k in range(2, 4000)], "doc_id bigint, text string, source string")
    n = mixing.replicate(df, {"rare": 1, "big": 1}).filter("source = 'rare'").count()
    assert 1700 < n < 2300


def test_same_draws_at_any_partitioning_and_in_shuffled_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a, b = (mixing.replicate(docs.repartition(p)).select("doc_id", "copy").collect() for p in (1, 7))
    assert sorted(a) == sorted(b) and [r.doc_id for r in a] != sorted(r.doc_id for r in a)


def test_odd_rows(odd, none):
    out = mixing.replicate(odd)
    assert sorted(out.columns) == sorted(odd.columns)  # its own column named copy is replaced
    counts = {(r.doc_id, r.lang): r["count"] for r in out.groupBy("doc_id", "lang").count().collect()}
    assert counts.get((4, "en"), 0) % 2 == 0  # equal rows draw alike
    assert mixing.replicate(none).count() == 0
