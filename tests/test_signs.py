"""The search that tells what texts may hold: nothing that an exact expression finds is missed, and nothing is decided otherwise."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from granary.functions import indicators as I
from granary.functions import signs, text
from granary.operators import rules
from granary.plans.policy import POLICY, SIGNALS

PIECES = ["CVE-2021-44228", "cVe-2020-12345", "xCVE-2020-1234", "éCVE-2020-1234", "a" * 32, "0F" * 20, "b" * 65, "10.1.2.3", "1.10.1.2.3", "x.com", "a-.Co", "-a.uk", "a.b.c.io", "é.com", "C:\\Temp\\a", "xC:\\T", "HKLM\\Run", "hkey_users\\a", "/etc/passwd", "//etc/x", "x/etc/y", "é/tmp/z", "/etc/", "Event ID: 4624", "event\x0bid\x0b#\x0b4688", "eid4688", "EVENT\t id #123456", "T1055", "xT1055", "AML.T0043?", "XAML.T0043", "T1055.0012", "[General Knowledge]", "[general\nknowledge]", "query", "QUERY.", "ſlog", "\u212alog", "log\u212a", "PİVOT", "p\u0130", "revİew", "s\u0130gma", "false \u0130", "check logs", "Check LOGS", "check log\u017f", "best practices", "false positive", "scope-", "語語", "٣٤", "a_b", "don't", "\u0301", "\U0001d400", ".", "-", "/", "\\", "'", "\n", "\u2028"]
WAS = {
    I.CVE: r"(?i)\b(CVE-[0-9]{4}-[0-9]{4,7})\b", I.IPV4: rf"\b((?:{I._BYTE}\.){{3}}{I._BYTE})\b", I.DOMAIN: rf"\b((?:[0-9A-Za-z](?:[0-9A-Za-z-]{{0,61}}[0-9A-Za-z])?\.)+(?:{'|'.join(I.TOP_DOMAINS)}))\b", I.DRIVE: r"""(?i)\b([A-Z]:\\[^\s"'<>|]+)""",
    I.REGISTRY: rf"(?i)\b((?:{I._HIVES})\\[\w\\/*.$%{{}}-]+)", I.UNIX: rf"""(?:^|[^\w])(/(?:{I._ROOTS})/[^\s"'<>]+)""", I.EVENT: r"(?i)\b(?:EID|Event\s+ID)\s*[-:#]?\s*([0-9]{3,5})\b", rules.MITRE_IN: rf"\b({rules._NUMBER})\b", rules.ATLAS_IN: rf"\b(AML\.{rules._NUMBER})\b",
}


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(12)
    one = lambda: "".join(rng.choice(PIECES) + rng.choice(["", "", " ", " ", "\n", "\xa0", ","]) for _ in range(rng.randint(0, 9)))
    rows = [(k, one(), one(), one(), one()) for k in range(3000)] + [(3000 + k, p, p, p, p) for k, p in enumerate(PIECES)] + [(-1, None, None, None, None), (-2, "", "", "", "")]
    df = spark.createDataFrame(rows, "k int, i string, r string, l string, a string").repartition(4)
    terms = [*rules.VERBS, *rules.PENALTIES, *(t for of in SIGNALS.values() for t in of)]
    s = signs.signs(F.col("i"), F.col("r"), F.col("l"), F.col("a"), list(I.RE2_SIGNS.values()), rules.NUMBER_SIGN, text.GENERAL, terms)
    return df.withColumn("s", s).withColumn("o", F.concat_ws("\n", "i", "r", "l")).cache()


def test_no_indicator_number_or_tag_is_missed(odd):
    kinds = rules._kinds(F.col("s"))
    for p, may in kinds.items():
        assert odd.filter((F.size(I._all(F.col("o"), p)) > 0) & ~may).count() == 0, p
        assert odd.filter(~may).count() > 100, p
    numbered = F.regexp_like("r", F.lit(rules.MITRE_IN)) | F.regexp_like("r", F.lit(rules.ATLAS_IN))
    for found, bit in ((numbered, signs.NUMBER), (F.regexp_like("r", F.lit(text.GENERAL)), signs.GENERAL)):
        assert odd.filter(F.coalesce(found, F.lit(True)) & ~signs.has(F.col("s"), bit)).count() == 0
        assert odd.filter(~signs.has(F.col("s"), bit)).count() > 100


def test_no_term_is_missed(odd):
    may, terms = signs.has(F.col("s"), signs.TERM), [*rules.VERBS, *rules.PENALTIES, *(t for of in SIGNALS.values() for t in of)]
    held = text.matching_terms(F.col("a"), terms) > 0
    assert odd.filter(F.coalesce(held, F.lit(True)) & ~may).count() == 0
    assert odd.filter(~may).count() > 100 and odd.filter(held).count() > 100


def test_patterns_find_what_they_found(odd):
    for p, was in WAS.items():
        for c in ("o", "r"):
            assert odd.filter(~I._all(F.col(c), p).eqNullSafe(I._all(F.col(c), was))).count() == 0, p
        assert odd.filter(F.size(I._all(F.col("o"), was)) > 0).count() > 20, p


def test_words_are_bounded_and_exact_for_ascii(odd):
    n, most = text.word_count(F.col("r")), F.col("s.words")
    assert odd.filter((most < n) | (signs.has(F.col("s"), signs.ASCII) & (most != n))).count() == 0
    assert odd.filter(signs.has(F.col("s"), signs.ASCII) & (most > 2)).count() > 100


def test_rules_decide_the_same_with_signs_as_without(odd):
    r, a, o, kinds, has = F.col("r"), F.col("a"), F.col("o"), rules._kinds(F.col("s")), lambda bit: signs.has(F.col("s"), bit)
    kind = F.when(F.col("k") % 2 == 0, "source_only").otherwise("source_plus_general")
    category = F.element_at(F.array(*map(F.lit, SIGNALS)), F.pmod("k", F.lit(len(SIGNALS))) + 1)
    ids = F.array(F.lit("T1055"))
    long = F.concat(r, F.repeat(F.lit(" a"), 650))
    for got, want in (
        (rules.invented(o, F.coalesce(a, F.lit("")), kind, kinds), rules.invented(o, F.coalesce(a, F.lit("")), kind)), (rules.grounding(kind, r, has(signs.GENERAL)), rules.grounding(kind, r)),
        (rules.mapping_ids(ids, ids, r, [], [], has(signs.NUMBER)), rules.mapping_ids(ids, ids, r, [], [])),
        (rules.relevance(a, category, SIGNALS, may_have=has(signs.TERM)), rules.relevance(a, category, SIGNALS)), (rules.specificity(r, a, kinds), rules.specificity(r, a)),
        (rules.completeness(long, a, F.col("s.words") + 650, has(signs.ASCII)), rules.completeness(long, a)),
    ):
        assert odd.filter(~got.eqNullSafe(want)).count() == 0


def test_terms_that_are_not_ascii_are_always_looked_for(spark):
    assert signs.term_pattern(["log", "spüren"]) is None
    df = spark.createDataFrame([("nothing",), ("",)], "t string")
    for terms, want in ((["log", "spüren"], True), (["log"], False), ([], False)):
        s = signs.signs(*[F.col("t")] * 4, list(I.RE2_SIGNS.values()), rules.NUMBER_SIGN, text.GENERAL, terms)
        assert [r[0] for r in df.select(signs.has(s, signs.TERM)).collect()] == [want] * 2


def test_texts_without_signs_are_not_searched_by_the_rules(spark, sf):
    spark.conf.set("spark.sql.maxPlanStringLength", 1 << 26)
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    plan = entry.queries()["val_00_row_decision"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(I.ANY_SIGN) == 0 and plan.count(f"{rules.NUMBER_SIGN},") == 0 and plan.count("ArrowEvalPython") == 1


def test_rules_are_the_same_over_no_rows(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    from granary.plans.base import candidates

    none = candidates(spark, sf).limit(0)
    assert rules.decided(none, POLICY).count() == 0 and rows.count() > 0
