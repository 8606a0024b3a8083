"""Queries of the compaction rules: each document becomes one of a rule's kind, and what the rule shows of it is read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import compaction
from granary.plans.base import query, table

C = F.col
LONG = "d" * 3000


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _items(n: Column, make) -> Column:
    """make(i) for i from 0 to n - 1, one below the other."""
    return F.array_join(F.transform(F.filter(F.sequence(F.lit(0), F.lit(60)), lambda i: i < n), lambda i: make(i.cast("bigint"))), "\n")


def _shown(made: Column, pattern: str) -> Column:
    return F.array_join(F.regexp_extract_all(made, F.lit(pattern), F.lit(1)), ",")


def _text(i: Column) -> Column:
    return i.cast("string")


_RANKED = "array_to_string(list_transform(list_sort(list_transform(list_sort({items})[1:{k}], lambda t: t.i)), lambda i: i::VARCHAR), ',')"


def _chosen(score: str, n: str, k: int, more: str = "") -> str:
    """SQL: the k of n items with the highest score, ties to the first, in their order."""
    return _RANKED.format(items=f"list_transform(range({n}), lambda i: struct_pack(s := -({score}){more}, i := i))", k=k)


_CONCRETE, _VERB, _WIDE = "(doc_id + i * 7) % 3 = 0", "(doc_id + i) % 4 = 0", "i % 5 = 0"


@query("SELECT doc_id, " + _chosen(f"CASE WHEN {_CONCRETE} THEN 4 ELSE 0 END + CASE WHEN {_VERB} THEN 1 ELSE 0 END + CASE WHEN {_WIDE} THEN 1 ELSE 0 END", "10 + doc_id % 30", 18) + " AS shown, least(8, doc_id % 12) AS mitigations FROM documents")
def cmp_01_attack(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C("doc_id")
    line = lambda i: F.concat(F.lit("- #"), _text(i), F.lit(" "), F.when((d + i * 7) % 3 == 0, "ran `cmd` ").otherwise(""), F.when((d + i) % 4 == 0, "executed ").otherwise(""), F.when(i % 5 == 0, F.lit("z" * 230)).otherwise(""))
    doc = F.concat(F.lit("# T\n\n## Description\n"), F.lit(LONG), F.lit("\n\n## Procedures\n"), _items(10 + d % 30, line), F.lit("\n\n## Mitigations\n"), _items(d % 12, lambda i: F.concat(F.lit("- m"), _text(i))))
    made = compaction.attack(doc)
    return _docs(spark, sf_dir).select("doc_id", _shown(made, r"(?m)^- #([0-9]+)").alias("shown"), F.regexp_count(made, F.lit("(?m)^- m[0-9]+")).cast("bigint").alias("mitigations"))


@query("""SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(range(doc_id % 20), lambda i: struct_pack(s := -((doc_id * 13 + i * 7) % 100), i := i)))[1:12], lambda t: t.i::VARCHAR), ',') AS shown,
  least(8, doc_id % 14) AS practices, 2 * least(12, doc_id % 20) AS remediations FROM documents""")
def cmp_02_advisory(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C("doc_id")
    score = lambda i: (d * 13 + i * 7) % 100
    block = lambda i: F.concat(F.lit("### CVE-"), _text(i), F.lit("\n- **CVSS Score**: "), F.floor(score(i) / 10).cast("string"), F.lit("."), (score(i) % 10).cast("string"), F.lit(" (x)\n**Remediations**:\n- **fix**: a\n- **fix**: b\n- **fix**: c"))
    twice = lambda i: F.concat(F.lit("## Recommended Practices\npractice "), _text(F.least(i, d % 14 - 1)))
    doc = F.concat(F.lit("# A\n\n"), F.when(d % 14 > 0, _items(d % 14 + 3, twice)).otherwise(""), F.lit("\n## Vulnerabilities\n"), _items(d % 20, block))
    made = compaction.advisory(doc)
    return _docs(spark, sf_dir).select("doc_id", _shown(made, "(?m)^### CVE-([0-9]+)").alias("shown"), F.regexp_count(made, F.lit("(?m)^- practice")).cast("bigint").alias("practices"), F.regexp_count(made, F.lit(r"(?m)^- \*\*fix")).cast("bigint").alias("remediations"))


@query("SELECT doc_id, " + _chosen("CASE WHEN (doc_id + i) % 11 = 0 THEN 10000 ELSE 0 END + (doc_id + i * 5) % 28", "doc_id % 45", 20, ", d := -((doc_id + i * 3) % 28)") + " AS shown FROM documents")
def cmp_03_kev(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C("doc_id")
    day = lambda x: F.lpad((x % 28 + 1).cast("string"), 2, "0")
    block = lambda i: F.concat(F.lit("### CVE-"), _text(i), F.lit("\n- **Date Added**: 2022-01-"), day(d + i * 5), F.lit("\n- **Due Date**: 2022-03-"), day(d + i * 3), F.lit("\n- **Ransomware use**: "), F.when((d + i) % 11 == 0, "Yes").otherwise("No"))
    doc = F.concat(F.lit("# Vendor\n\n## Summary\n"), F.lit(LONG), F.lit("\n\n## Details\n"), _items(d % 45, block))
    return _docs(spark, sf_dir).select("doc_id", _shown(compaction.kev(doc), "(?m)^### CVE-([0-9]+)").alias("shown"))


_FLAGS = {"Raises privileges": (4, 5), "Auto-elevates": (3, 7), "Condition": (1, 2), "Variable": (1, 3)}


@query("SELECT doc_id, " + _chosen(" + ".join(f"CASE WHEN (doc_id + i) % {m} = 0 THEN {w} ELSE 0 END" for w, m in _FLAGS.values()), "doc_id % 50", 28) + " AS shown FROM documents")
def cmp_04_hijack(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C("doc_id")
    block = lambda i: F.concat(F.lit("### `p"), _text(i), F.lit("`"), *[F.when((d + i) % m == 0, f"\n- **{name}**: yes").otherwise("") for name, (_, m) in _FLAGS.items()])
    doc = F.concat(F.lit("# H\n\n## Expected locations\n"), F.lit(LONG), F.lit("\n\n## Vulnerable executables\n"), _items(d % 50, block))
    return _docs(spark, sf_dir).select("doc_id", _shown(compaction.hijack(doc), "(?m)^### `p([0-9]+)`").alias("shown"))


@query("SELECT doc_id, " + _chosen("CASE WHEN (doc_id + i) % 9 = 0 THEN 8 ELSE 0 END + CASE WHEN (doc_id + i) % 4 = 0 THEN 2 ELSE 0 END + CASE WHEN (doc_id + i) % 3 = 0 THEN 1 ELSE 0 END", "doc_id % 26", 14) + " AS shown, least(30, doc_id % 40) AS hashes FROM documents")
def cmp_05_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples that come twice; of equal ones the first counts."""
    d = C("doc_id")
    numbers = F.filter(F.sequence(F.lit(0), F.lit(60)), lambda i: i < d % 26)
    sample = lambda i: F.struct(
        F.format_string("f%d", i).alias("filename"), F.when((d + i) % 3 == 0, "c").alias("company"), F.when((d + i) % 9 == 0, "True").otherwise("false").alias("loads_despite_hvci"), F.struct(F.when((d + i) % 4 == 0, F.format_string("s%d", i)).alias("sha256")).alias("hashes")
    )
    samples = F.transform(numbers, sample)
    hashes = F.transform(F.filter(F.sequence(F.lit(0), F.lit(60)), lambda i: i < d % 40), lambda i: F.format_string("h%d", i))
    meta = F.to_json(F.struct(F.concat(samples, F.slice(samples, 1, 5)).alias("samples"), hashes.alias("hashes")))
    made = compaction.driver(F.concat(F.lit("# D\n\n## Samples\n"), F.lit("x" * 12_000)), meta)
    return _docs(spark, sf_dir).select("doc_id", _shown(made, "(?m)^### f([0-9]+)$").alias("shown"), F.regexp_count(made, F.lit("(?m)^- `h[0-9]+`$")).cast("bigint").alias("hashes"))


@query("SELECT doc_id, least(8, doc_id % 14) AS steps, least(12, doc_id % 25) AS code_lines, greatest(0, doc_id % 25 - 12) AS lost FROM documents")
def cmp_06_skill(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C("doc_id")
    doc = F.concat(F.lit("# S\n\n## Overview\nsee\n```sh\n"), _items(d % 25, lambda i: F.concat(F.lit("code "), _text(i))), F.lit("\n```\n\n## Other\n"), F.lit(LONG), F.lit("\n\n## Workflow\n"), _items(d % 14, lambda i: F.concat(F.lit("### Step "), _text(i), F.lit("\ndo it"))))
    made = compaction.skill(doc)
    return _docs(spark, sf_dir).withColumn("made", made).select("doc_id", F.regexp_count("made", F.lit("(?m)^### Step")).cast("bigint").alias("steps"), F.regexp_count("made", F.lit("(?m)^code [0-9]")).cast("bigint").alias("code_lines"), F.coalesce(F.regexp_extract("made", r"\[([0-9]+) more lines", 1).try_cast("bigint"), F.lit(0)).alias("lost"))


@query("SELECT doc_id, md5('SELECT ' || repeat(md5(text), 200)) AS query, CASE doc_id % 4 WHEN 0 THEN 'vql' WHEN 1 THEN 'csv' WHEN 2 THEN 'json' ELSE '' END AS language FROM documents")
def cmp_07_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts whose queries are longer than any limit, and whose parameters' defaults are queries, tables, JSON or plain."""
    kind = C("doc_id") % 4
    default = F.when(kind == 0, "LET x = 1").when(kind == 1, F.repeat(F.lit("a,b\n"), 80)).when(kind == 2, F.concat(F.lit("["), F.repeat(F.lit("1 "), 200), F.lit("]"))).otherwise(F.repeat(F.lit("p"), 300))
    whole = F.concat(F.lit("SELECT "), F.repeat(F.md5("text"), 200))
    yaml = F.to_json(F.struct(F.lit("A").alias("name"), F.array(F.struct(F.lit("p").alias("name"), default.alias("default"))).alias("parameters"), F.array(F.struct(F.lit("S").alias("name"), whole.alias("query"))).alias("sources")))
    made = compaction.artifact(F.concat(F.lit("# V\n\n```yaml\n"), yaml, F.lit("\n```\n")), F.lit("{}"))
    return _docs(spark, sf_dir).withColumn("made", made).select("doc_id", F.md5(F.regexp_extract("made", r"(?s)## S: query\n```vql\n(.*?)\n```", 1)).alias("query"), F.regexp_extract("made", r"## Default of p\n```([a-z]+)", 1).alias("language"))
