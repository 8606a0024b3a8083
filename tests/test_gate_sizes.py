"""What the gate's queries do on larger tables: copies, and rules that are evaluated once."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from granary.functions import indicators, text
from granary.operators import neardup, rules
from granary.plans import gate
from granary.plans.policy import SIGNALS


def rows_of(spark, rows):
    return spark.createDataFrame([(k, r, [str(x) for x in t]) for k, r, t in rows], "key bigint, rank bigint, tokens array<string>")


def random_rows():
    rng = random.Random(11)
    rows = []
    for k in range(220):
        base = set(rng.sample(range(80), rng.randint(4, 30))) if k < 25 or rng.random() < 0.1 else set(rng.choice(rows)[2])
        if rng.random() < 0.6:
            base ^= {rng.randrange(80)}
        rows.append((k, None, base))
    ranks = rng.sample(range(1000), len(rows))
    return [(k, r, t) for (k, _, t), r in zip(rows, ranks)]


def close(x, y):
    return len(x & y) / len(x | y) >= 0.8 if x and y else False


def test_rows_dropped_by_class_are_those_of_the_greedy_loop(spark):
    rows = random_rows()
    kept, want = [], {}
    for key, _, t in sorted(rows, key=lambda r: r[1]):
        above = [k for k, s in kept if close(s, t)]
        if len(t) >= 8 and above:
            want[key] = min(above)
        else:
            kept.append((key, t))
    assert {r.key: r.kept_key for r in neardup.dropped_rows(rows_of(spark, rows), least_tokens=8).collect()} == want


def test_class_pairs_lose_no_link_between_texts(spark):
    rows = random_rows()
    got = {(r.a, r.b) for r in neardup.class_pairs(rows_of(spark, rows), least_tokens=8).collect()}
    sets = {k: frozenset(t) for k, _, t in rows}
    by_rank = sorted(rows, key=lambda r: r[1])
    want = {frozenset((sets[a], sets[b])) for i, (a, _, x) in enumerate(by_rank) for b, _, y in by_rank[i + 1 :] if len(y) >= 8 and close(x, y)}
    assert {frozenset((sets[a], sets[b])) for a, b in got} == want
    assert len(got) == len({(a, b) for a, b in got if sets[a] != sets[b]}) + sum(len(t) >= 8 for t in sets.values()) - len({t for t in sets.values() if len(t) >= 8})


def test_copies_have_a_row_each_in_place_of_all_their_pairs(spark):
    rows = rows_of(spark, [(k, k, range(20)) for k in range(300)])
    assert sorted((r.a, r.b, r.jaccard) for r in neardup.class_pairs(rows, least_tokens=8).collect()) == [(0, k, 1.0) for k in range(1, 300)]


@pytest.mark.parametrize("columns", [("category",), ("doc_id", "lang", "score_total")])
def test_a_filter_on_status_does_not_evaluate_the_rules_again(spark, sf, columns):
    times = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count(indicators.REGISTRY)
    spark.conf.set("spark.sql.maxPlanStringLength", 1 << 26)
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    rows = gate.decisions(spark, sf).select("quality_status", *columns)
    assert 0 < times(gate.filtered(spark, sf, *columns)) == times(rows)


def test_counts_of_issues_evaluate_the_rules_once(spark, sf):
    times = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count(indicators.REGISTRY)
    spark.conf.set("spark.sql.maxPlanStringLength", 1 << 26)
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    rows = gate.decisions(spark, sf).select("quality_status", F.size("issues"))
    assert 0 < times(entry.queries()["agg_03_issue_counts"](spark, sf)) == times(rows)


PIECES = ["CVE-2021-44228", "cVe-2020-12345", "xCVE-2020-1", "a" * 32, "0F" * 20, "é" + "b" * 32, "10.1.2.3", "1.2.3", "999.1.1.1", "x.com", "a.b.Co", ".com", "x.comé", "C:\\Temp\\a", "HKLM\\Run", "/etc/passwd", "/etc/", "b/usr/x", "Event ID: 4624", "eid4688", "xEID 1234", "EVENT\t id #12", "query", "9query", "x_query", "query.", "queries", "scope-", "-scope", "Review", "check logs", "best  practices", "follow best practices", "false positive", "ärger", "語語", "٣٤", ".", "-", "/", "\\", "'", "\n", "T1055", "AML.T0043?"]


@pytest.fixture(scope="module")
def odd_texts(spark):
    rng = random.Random(5)
    texts = ["", " ", "\n", *PIECES, *["".join(rng.choice(PIECES) + rng.choice(["", " ", " ", "\n", "\xa0", ","]) for _ in range(rng.randint(1, 12))) for _ in range(1500)], None]
    return spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(4).cache()


def test_texts_without_a_sign_have_no_indicator(odd_texts):
    t, empty = F.col("t"), F.array().cast("array<string>")
    for pattern in indicators.SIGNS:
        every = indicators._all(t, pattern)
        assert odd_texts.filter((F.coalesce(every, empty) != indicators._some(t, pattern)) | ((F.size(every) > 0) & ~indicators.may_have(t))).count() == 0, pattern
        assert odd_texts.filter(F.size(every) > 0).count() > 10, pattern
    assert odd_texts.filter(~indicators.may_have(t)).count() > 100
    assert odd_texts.filter(t.isNull() & indicators.indicators(t).isNotNull()).count() == 0


def test_terms_and_words_are_counted_as_by_lists_of_all(odd_texts):
    t, low = F.col("t"), F.lower("t")
    for terms in (SIGNALS["detection_engineering"], rules.VERBS, rules.PENALTIES, ["ab", "query", "t1055", "c++"]):
        want = F.lit(0)
        for x in terms:
            want = want + F.when(F.contains(low, F.lit(x)) if " " in x else F.array_contains(text.raw_tokens(low), x), 1).otherwise(0)
        assert odd_texts.filter(t.isNotNull() & (text.matching_terms(t, terms) != want)).count() == 0, terms
    for n in (1, 2, 5, 9):
        assert odd_texts.filter(text.has_words(t, n) != (text.word_count(t) >= n)).count() == 0, n


def test_shared_tokens_count_beyond_the_openings(spark):
    words = " ".join(f"token{k}" for k in range(6))
    texts = [(f"{'xyzw ' * 200}{words}", f"{'abcd ' * 200}{words}", 4.5), (words, f"{'abcd ' * 200}{words[:27]}", 4.0), ("y" * 2000, f"{'abcd ' * 200}", 2.0), (f"{words} more", f"{words} other", 4.5)]
    df = spark.createDataFrame(texts, "c string, a string, want double")
    assert [r[0] for r in df.select(rules.specificity(F.col("a"), F.col("c")) == F.col("want")).collect()] == [True] * 4


def test_rules_read_the_answer_in_lower_case_once(spark, sf):
    spark.conf.set("spark.sql.maxPlanStringLength", 1 << 26)
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    for name in ("agg_01_status_counts", "val_00_row_decision"):
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("lower(final_answer") == 1
