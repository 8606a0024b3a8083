"""Queries of readers and writers: whole tables are written as files of each format and read back.

The files lie in the folder that all executors share and are removed with the application's other tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.lineage import made, shared_folder
from granary.operators import runs
from granary.plans.base import query, table
from granary.sources import collectors_more, connectors, jsonl, sinks

C = F.col


def _folder(spark: SparkSession) -> str:
    return made(f"{shared_folder(spark).rstrip('/')}/files-{uuid.uuid4().hex}")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _named(spark: SparkSession, folder: str, ending: str) -> str:
    """folder, its data files renamed to end so: writers have endings of their own."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files, found = fs.listFiles(path, True), []
    while files.hasNext():
        at = files.next().getPath()
        if at.getName().startswith("part-"):
            found.append(at)
    for at in found:
        fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), at.getName().split(".")[0] + ending))
    return folder


def _text(spark: SparkSession, rows: DataFrame, value: Column, ending: str, order: list[str], folder: str | None = None) -> str:
    """Rows as one text file in this order."""
    folder = folder or _folder(spark)
    rows = rows.repartition(1)
    (rows.sortWithinPartitions(*order) if order else rows).select(value.alias("value")).write.text(folder)
    return _named(spark, folder, ending)


def _parts(spark: SparkSession, rows: DataFrame, value: Column, ending: str, order: list[str]) -> str:
    """Rows in this order as text files that follow one another by name, a range of rows each."""
    folder = _folder(spark)
    rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).select(value.alias("value")).write.text(folder)
    return _named(spark, folder, ending)


def _corpus(spark: SparkSession, sf_dir: str) -> str:
    """documents as a corpus of raw documents, a folder and a file for each source, in order of doc_id."""
    folder = _folder(spark)
    docs = _docs(spark, sf_dir)
    row = F.struct(
        F.format_string("d-%d", "doc_id").alias("doc_id"), F.col("source"), F.lit("https://host/x").alias("source_url"), F.col("lang").alias("title"), F.lit("2024-01-02").alias("date_collected"), F.lit("2024-01-01T00:00:00Z").alias("date_published"),
        F.lit("page").alias("content_type"), F.col("text").alias("content_markdown"), F.lit("{}").alias("metadata_json"), F.col("n_chars").alias("word_count"),
    )
    rows = docs.select(C("source").alias("folder"), "doc_id", F.to_json(row).alias("value")).repartition("folder").sortWithinPartitions("folder", "doc_id")
    rows.drop("doc_id").write.partitionBy("folder").text(folder)
    return _named(spark, folder, ".jsonl")


# ---------------------------------------------------------------- sources


@query("SELECT 'folder=' || source AS folder, count(DISTINCT source) AS files FROM documents GROUP BY source")
def src_01_corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = jsonl.corpus_files(spark, _corpus(spark, sf_dir))
    return files.groupBy(F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("folder")).agg(F.count("*").alias("files"))


@query("SELECT 'd-' || doc_id AS doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS line_number, md5(text) AS digest FROM documents")
def src_02_numbered_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.numbered_documents(spark, _corpus(spark, sf_dir)).select("doc_id", "line_number", F.md5("content_markdown").alias("digest"))


@query("SELECT 'd-' || doc_id AS doc_id, source, lang AS title, md5(text) AS digest, n_chars AS word_count, DATE '2024-01-02' AS day FROM documents")
def src_03_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.raw_documents(spark, _corpus(spark, sf_dir)).select("doc_id", "source", "title", F.md5("content_markdown").alias("digest"), "word_count", C("date_collected").alias("day"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def src_04_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with blank ones between them."""
    rows = _docs(spark, sf_dir).select("doc_id", F.concat(F.to_json(F.struct("doc_id", "text")), F.when(C("doc_id") % 3 == 0, "\n\n").otherwise("")).alias("value"))
    folder = _folder(spark)
    rows.select("value").write.text(folder)
    return jsonl.json_lines(spark, folder, "doc_id bigint, text string").select("doc_id", F.md5("text").alias("digest"))


@query("SELECT lang AS name, count(*) AS n FROM documents GROUP BY lang")
def src_05_json_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object over many lines, beside one that can't be parsed; a missing one gives no rows."""
    counts = _docs(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "n")))).alias("counts"))
    folder = _text(spark, counts, F.to_json(F.struct("counts"), {"pretty": "true"}), ".json", [])
    bad = _text(spark, spark.range(1), F.lit('{"counts": [,'), ".json", [])
    schema = "counts map<string, bigint>"
    rows = jsonl.json_file(spark, folder, schema).unionByName(jsonl.json_file(spark, bad, schema)).unionByName(jsonl.json_file(spark, f"{folder}/none", schema))
    return rows.select(F.explode("counts").alias("name", "n"))


@query("SELECT doc_id, lang, n_chars FROM documents")
def src_06_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A YAML document for each row, many in a file; empty ones between them are none."""
    rows = _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("--- "), F.to_json(F.struct("doc_id", "lang", "n_chars")), F.when(C("doc_id") % 5 == 0, "\n---").otherwise("")).alias("value"))
    folder = _folder(spark)
    rows.select("value").write.text(folder)
    found = jsonl.yaml_documents(spark, _named(spark, folder, ".yml")).filter("error is null")
    return found.select(F.from_json("json", "doc_id bigint, lang string, n_chars bigint").alias("r")).select("r.*")


@query("""SELECT row_number() OVER (ORDER BY doc_id) AS line_number, CASE doc_id % 5 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'not an object' WHEN 2 THEN 'missing: text' WHEN 3 THEN 'unknown value: level' END AS problem,
  CASE WHEN doc_id % 5 = 4 THEN md5(text) END AS digest FROM documents""")
def src_07_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = C("doc_id") % 5
    good = F.to_json(F.struct("text", F.when(kind == 3, "top").otherwise("mid").alias("level")))
    line = F.when(kind == 0, F.lit("{no")).when(kind == 1, F.lit("[]")).when(kind == 2, F.to_json(F.struct(F.lit("mid").alias("level")))).otherwise(good)
    folder = _parts(spark, _docs(spark, sf_dir).select("doc_id", line.alias("line")), C("line"), ".jsonl", ["doc_id"])
    found = jsonl.checked(spark, folder, "text string, level string", ["text", "level"], {"level": ["junior", "mid", "senior"]}, across=True)
    return found.select("line_number", "problem", F.when(C("problem").isNull(), F.md5("row.text")).alias("digest"))


@query("SELECT 'case-' || item_id AS case_id, text AS prediction FROM benchmark")
def src_08_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select(F.format_string("case-%d", "item_id").alias("case_id"), C("text").alias("prediction"))
    folder = _folder(spark)
    rows.write.json(folder)
    return jsonl.predictions(spark, folder)


@query("SELECT row_number() OVER (ORDER BY item_id % 3, item_id) AS nth, 'case-' || item_id AS case_id, text AS prompt FROM benchmark")
def src_09_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases in three files, read in the order of their names."""
    rows = table(spark, sf_dir, "benchmark").withColumn("part", C("item_id") % 3)
    value = F.to_json(F.struct(F.format_string("case-%d", "item_id").alias("case_id"), C("text").alias("prompt")))
    folder = _folder(spark)
    rows.repartitionByRange(3, "part").sortWithinPartitions("part", "item_id").select(value.alias("value")).write.text(folder)
    return jsonl.cases(spark, _named(spark, folder, ".jsonl")).select("nth", "case_id", "prompt")


@query("SELECT DISTINCT 'T' || lpad((doc_id % 7919)::VARCHAR, 4, '0') AS id FROM documents WHERE doc_id % 4 <> 1 AND doc_id % 6 <> 2 AND doc_id % 10 <> 3")
def src_10_attack_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bundle for each source; other types, revoked and misshapen ones among its objects."""
    outer = F.struct(F.lit("mitre-attack").alias("source_name"), F.concat(F.when(C("doc_id") % 10 == 3, "X").otherwise("T"), F.lpad((C("doc_id") % 7919).cast("string"), 4, "0")).alias("external_id"))
    one = F.struct(F.when(C("doc_id") % 4 == 1, "malware").otherwise("attack-pattern").alias("type"), (C("doc_id") % 6 == 2).alias("revoked"), F.array(F.struct(F.lit("web").alias("source_name"), F.lit("T0000").alias("external_id")), outer).alias("external_references"))
    bundles = _docs(spark, sf_dir).groupBy("source").agg(F.collect_list(one).alias("objects"))
    folder = _folder(spark)
    bundles.select(F.to_json(F.struct("objects")).alias("value"), "source").repartition("source").write.partitionBy("source").text(folder)
    return jsonl.attack_ids(spark, _named(spark, folder, ".json"))


@query("SELECT DISTINCT 'AML.T' || lpad((doc_id % 7919)::VARCHAR, 4, '0') AS id FROM documents WHERE doc_id % 9 <> 0")
def src_11_atlas_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.struct(F.concat(F.when(C("doc_id") % 9 == 0, "AML.X").otherwise("AML.T"), F.lpad((C("doc_id") % 7919).cast("string"), 4, "0")).alias("id"), C("lang").alias("name"))
    matrix = _docs(spark, sf_dir).groupBy("source").agg(F.array(F.struct(F.collect_list(one).alias("techniques"))).alias("matrices"))
    folder = _folder(spark)
    matrix.select(F.concat(F.lit("--- "), F.to_json(F.struct("matrices"))).alias("value")).write.text(folder)
    return collectors_more.atlas_ids(jsonl.yaml_documents(spark, _named(spark, folder, ".yaml")))


@query("SELECT doc_id, lang, 1 AS downloads FROM documents")
def src_13_cached_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed downloaded once: the second reading finds the first one's file."""
    entries = _docs(spark, sf_dir).groupBy().agg(F.array_sort(F.collect_list(F.struct("doc_id", "lang"))).alias("entries"))
    local = _folder(spark).removeprefix("file:")
    folder = _text(spark, entries, F.to_json(F.struct("entries")), ".json", [], f"{local}/made")
    import glob

    source = glob.glob(f"{folder}/*.json")[0]
    times = sum(connectors.download(f"file://{source}", f"{local}/feed.json") for _ in range(2))
    rows = connectors.json_feed(spark, f"file://{source}", f"{local}/feed.json", "entries array<struct<doc_id:bigint,lang:string>>")
    return rows.select(F.explode("entries").alias("e")).select("e.doc_id", "e.lang", F.lit(times).alias("downloads"))


@query("SELECT doc_id, sha256('Write about ' || lang || '.' || chr(10) || text || chr(10)) AS prompt_hash FROM documents")
def src_15_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _text(spark, spark.range(1), F.lit("Write about $lang.\n$text"), ".md", [])
    prompt = runs.prompt_text(jsonl.template(spark, folder), {"lang": C("lang"), "text": C("text")})
    return _docs(spark, sf_dir).select("doc_id", F.sha2(prompt, 256).alias("prompt_hash"))


# ---------------------------------------------------------------- sinks


@query("SELECT doc_id, text, true AS ascii, (SELECT count(*) FROM documents) AS n FROM documents")
def snk_01_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    n = sinks.json_lines(_docs(spark, sf_dir).select("doc_id", "text"), folder)
    raw = spark.read.text(folder)
    return raw.select(F.from_json("value", "doc_id bigint, text string").alias("r"), (F.octet_length("value") == F.length("value")).alias("ascii")).select("r.doc_id", "r.text", "ascii", F.lit(n).cast("bigint").alias("n"))


@query("SELECT doc_id, lang FROM documents UNION ALL SELECT doc_id + 1000000, 'xx' FROM labels")
def snk_02_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    sinks.json_lines(_docs(spark, sf_dir).select("doc_id", "lang"), folder)
    sinks.append_json(table(spark, sf_dir, "labels").select((C("doc_id") + 1_000_000).alias("doc_id"), F.lit("xx").alias("lang")), folder)
    return jsonl.json_lines(spark, folder, "doc_id bigint, lang string")


@query("SELECT lang, count(*) AS n, 2 AS rows_said FROM documents WHERE lang IN ('en', 'de') GROUP BY lang")
def snk_04_replaced_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small report as one JSON file that takes its predecessor's place."""
    path = _folder(spark).removeprefix("file:") + ".json"
    counts = _docs(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"))
    sinks.report(counts, path)
    said = sinks.report(counts.filter(C("lang").isin("en", "de")), path)
    return spark.read.schema("lang string, n bigint").option("multiLine", True).json(path).select("lang", "n", F.lit(said).alias("rows_said"))


@query("SELECT source, doc_id, CASE WHEN source = 'src1' THEN 'new' ELSE lang END AS lang FROM documents")
def snk_05_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus by source, one of which is then written anew and alone replaced."""
    folder = _folder(spark)
    docs = _docs(spark, sf_dir).select("doc_id", "lang", "source")
    sinks.corpus(docs, folder)
    sinks.corpus(docs.filter("source = 'src1'").withColumn("lang", F.lit("new")), folder)
    return spark.read.parquet(folder).select(C("source").cast("string").alias("source"), "doc_id", "lang")


_ROUTED = "SELECT doc_id, lang, source, CASE WHEN doc_id % 3 = 0 THEN 'filtered' WHEN doc_id % 3 = 1 THEN 'review' ELSE 'rejected' END AS status FROM documents"


@query(f"""WITH r AS ({_ROUTED}) SELECT 'status' AS part, status AS name, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT 'source', source, count(*) FROM r WHERE status = 'filtered' GROUP BY ALL
UNION ALL SELECT 'category', lang, count(*) FROM r WHERE status = 'filtered' GROUP BY ALL UNION ALL SELECT 'taxonomy', x, count(*) FROM (SELECT unnest(['W1', lang]) AS x FROM r WHERE status = 'filtered') GROUP BY ALL
UNION ALL SELECT 'issues of ' || status, x, count(*) FROM (SELECT status, unnest(['code-' || doc_id % 2, 'other']) AS x FROM r WHERE status <> 'filtered') GROUP BY ALL""")
def snk_06_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = C("doc_id") % 3
    issue = lambda code: F.struct(code.alias("code"), F.lit("review").alias("severity"), F.lit("").alias("message"))
    issues = F.when(kind != 0, F.array(issue(F.concat(F.lit("code-"), (C("doc_id") % 2).cast("string"))), issue(F.lit("other"))))
    rows = _docs(spark, sf_dir).select("doc_id", "source", C("lang").alias("category"), F.array(F.lit("W1"), "lang").alias("taxonomy_refs"), issues.alias("issues"), F.when(kind == 0, "filtered").when(kind == 1, "review").otherwise("rejected").alias("quality_status"))
    found = sinks.by_status(rows, _folder(spark), "run-1")
    return spark.createDataFrame([(part, name, n) for part, names in found.items() for name, n in names.items()], "part string, name string, n bigint")


@query("SELECT doc_id, CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split FROM documents")
def snk_07_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits written where other ones were before, which are gone then."""
    k = C("doc_id") % 10
    rows = _docs(spark, sf_dir).select("doc_id", F.when(k < 8, "train").when(k == 8, "validation").otherwise("test").alias("split"))
    folder = _folder(spark)
    sinks.by_split(rows.withColumn("split", F.lit("old")), folder)
    sinks.by_split(rows, folder)
    return spark.read.schema("doc_id bigint, split string").json(folder)


@query("SELECT 'prompt-' || item_id AS prompt_id, text AS prompt, (SELECT count(*) FROM benchmark) AS prompt_count FROM benchmark")
def snk_08_prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run's prompts, their own files, and the manifest."""
    folder = _folder(spark)
    rows = table(spark, sf_dir, "benchmark").select(F.format_string("prompt-%d", "item_id").alias("prompt_id"), C("text").alias("prompt"))
    sinks.prompt_render(rows, folder, one_each=True)
    said = spark.read.schema("prompt_count bigint").option("multiLine", True).json(f"{folder}/manifest")
    each = spark.read.text(f"{folder}/files", wholetext=True).select(F.regexp_extract("_metadata.file_path", "file=([^/]*)", 1).alias("prompt_id"), F.regexp_replace("value", r"\n\z", "").alias("prompt"))
    listed = jsonl.json_lines(spark, f"{folder}/prompts", "prompt_id string, prompt string")
    return listed.intersectAll(each).crossJoin(said)


@query("SELECT 'case-' || item_id AS case_id, length(text)::BIGINT AS score, (SELECT sum(length(text))::BIGINT FROM benchmark) AS total, (SELECT count(*) FROM benchmark) AS said FROM benchmark")
def snk_09_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four outputs of an evaluation, written twice; each holds the later state."""
    folder = _folder(spark)
    rows = table(spark, sf_dir, "benchmark").select(F.format_string("case-%d", "item_id").alias("case_id"), C("text").alias("prediction"), F.length("text").cast("bigint").alias("score"), "item_id")
    for part in (rows.filter("item_id % 2 = 0"), rows):
        sinks.evaluation_checkpoint(part.select("case_id", "prediction"), part.select("case_id", "score"), part.agg(F.sum("score").alias("total")), folder, {"model": "m"})
    back = lambda name, schema: jsonl.json_lines(spark, f"{folder}/{name}", schema)
    scores = back("scores", "case_id string, score bigint").join(back("predictions", "case_id string, prediction string").select("case_id"), "case_id")
    return scores.crossJoin(back("scorecard", "total bigint")).crossJoin(back("run", "scores bigint").select(C("scores").alias("said")))


@query("SELECT 'run-' || doc_id % 2 AS run_id, doc_id, lang AS answer FROM documents")
def snk_10_teacher_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    for k in (0, 1):
        runs.teacher_log(_docs(spark, sf_dir).filter(C("doc_id") % 2 == k).select("doc_id", C("lang").alias("answer")), f"run-{k}", folder)
    return spark.read.parquet(folder).select(C("run_id").cast("string").alias("run_id"), "doc_id", "answer")


def _markdown_sql() -> str:
    from granary.plans.relational import _SCORES

    return _SCORES + """, gate AS (SELECT max(CASE WHEN task_type = '(all)' THEN tuned - baseline END) AS d, max(CASE WHEN task_type = '(all)' THEN tuned - baseline END) > 0 AND NOT bool_or(regressed) AS ok FROM cmp),
rows_ AS (SELECT task_type, format('| {} | {:.4f} | {:.4f} | {:+.4f}{} |', task_type, baseline, tuned, delta, CASE WHEN regressed THEN ' (worse)' ELSE '' END) AS line FROM cmp WHERE task_type <> '(all)')
SELECT '# Comparison' || chr(10) || chr(10) || format('Overall change: {:+.4f}. ', d) || CASE WHEN ok THEN 'Passes.' ELSE 'Fails.' END || chr(10) || chr(10) || '| task | baseline | tuned | change |' || chr(10) || '|---|---|---|---|' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY task_type) FROM rows_) AS report FROM gate"""


@query(_markdown_sql())
def snk_11_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    from granary.operators import evaluation
    from granary.plans.relational import _comparison

    both = _comparison(spark, sf_dir)
    return spark.createDataFrame([(sinks.markdown(both, evaluation.gate(both)),)], "report string")
