"""JSON lines and JSON, YAML and Markdown files as DataFrames, and what reading them can go wrong with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from granary.functions import text as X
from granary.operators.sampling import numbered

RAW_DOCUMENT = "doc_id string, source string, source_url string, title string, date_collected date, date_published timestamp, content_type string, content_markdown string, metadata_json string, word_count bigint"


def lines(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    """(file_path, line_number, value) of every line; the number is that in its file, or across all files in name order.

    Files are read in splits like any others: a line's number is its place in its split after the lines of the file's
    splits before, which a first scan counts. Reading them again in the same session gives the same splits.
    """
    found = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_gr_at"), "value")
    found = found.withColumn("_gr_m", F.monotonically_increasing_id())
    sizes = found.groupBy("file_path", "_gr_at").agg(F.count("*").alias("n"), F.min("_gr_m").alias("_gr_first"))
    before = F.coalesce(F.sum("n").over((Window.orderBy("file_path", "_gr_at") if across else Window.partitionBy("file_path").orderBy("_gr_at")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("_gr_before", before).drop("n")
    number = F.col("_gr_before") + F.col("_gr_m") - F.col("_gr_first") + 1
    return found.join(sizes, ["file_path", "_gr_at"]).select("file_path", number.alias("line_number"), F.regexp_replace("value", r"\r\z", "").alias("value"))


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Rows of JSON lines files, blank lines skipped; a missing path is an error."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of folder/*/*.jsonl; a line that isn't a document is an error when it is read."""
    return spark.read.schema(RAW_DOCUMENT).option("mode", "FAILFAST").json(f"{folder.rstrip('/')}/*/*.jsonl").withColumn("file_path", F.col("_metadata.file_path"))


def numbered_documents(spark: SparkSession, folder: str) -> DataFrame:
    """raw_documents with the line each stands on; a blank line is an error too when it is read."""
    found = lines(spark, f"{folder.rstrip('/')}/*/*.jsonl")
    bad = F.raise_error(F.concat(F.lit("no document at "), "file_path", F.lit(":"), F.col("line_number").cast("string"))).cast("string")
    row = F.from_json(F.when(F.try_parse_json("value").isNull(), bad).otherwise(F.col("value")), RAW_DOCUMENT)
    return found.select("file_path", "line_number", row.alias("d")).select("file_path", "line_number", "d.*")


def corpus_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the files that raw_documents reads, in name order."""
    return spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/*/*.jsonl").select("path").orderBy("path")


CASE = "case_id string, task_type string, difficulty string, prompt string, context string"


def cases(spark: SparkSession, path: str, schema: str = CASE) -> DataFrame:
    """Benchmark cases of one file, or of all *.jsonl files of a folder itself, with ``nth``, their place in name order."""
    path = path if path.endswith(".jsonl") else f"{path.rstrip('/')}/*.jsonl"
    found = lines(spark, path).filter(F.trim("value") != "")
    rows = numbered(found, ["file_path", "line_number"], "nth")
    return rows.select("nth", F.from_json("value", schema).alias("c")).select("nth", "c.*")


def template(spark: SparkSession, path: str) -> str:
    """The text of one prompt template."""
    return spark.read.text(path, wholetext=True).first()[0]


def checked(spark: SparkSession, path: str, schema: str, required: list[str], choices: dict[str, list[str]] | None = None, across: bool = False) -> DataFrame:
    """(file_path, line_number, row, problem): each line that isn't blank, parsed, and what is wrong with it (null: nothing).

    across: lines are numbered through all files of a folder, as those of one that was written in parts.
    """
    found = lines(spark, path, across).filter(F.trim("value") != "")
    return found.select("file_path", "line_number", F.from_json("value", schema).alias("row"), problem(F.col("value"), schema, required, choices or {}).alias("problem"))


def problem(value: Column, schema: str, required: list[str], choices: dict[str, list[str]]) -> Column:
    row = F.from_json(value, schema, {"mode": "PERMISSIVE"})
    parsed = F.try_parse_json(value)
    is_object = parsed.isNotNull() & F.regexp_like(value, F.lit(r"\A\s*\{"))
    missing = F.array_compact(F.array(*[F.when(row[c].isNull(), F.lit(c)) for c in required]))
    odd = F.array_compact(F.array(*[F.when(row[c].isNotNull() & ~row[c].isin(v), F.lit(c)) for c, v in choices.items()])) if choices else F.array().cast("array<string>")
    return (
        F.when(parsed.isNull(), "not JSON").when(~is_object, "not an object").when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
        .when(F.size(odd) > 0, F.concat(F.lit("unknown value: "), F.array_join(odd, ", ")))
    )


def json_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each JSON file; a file that can't be parsed is a row of nulls, a missing one an empty table."""
    try:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, prediction) to replay; a row without either, or a case that comes twice, is an error when read."""
    rows = json_lines(spark, path, "case_id string, prediction string")
    bad = F.raise_error(F.lit("a prediction without case_id or prediction")).cast("string")
    rows = rows.withColumn("case_id", F.when(F.col("case_id").isNull() | F.col("prediction").isNull(), bad).otherwise(F.col("case_id")))
    grouped = rows.groupBy("case_id").agg(F.count("*").alias("n"), F.first("prediction").alias("prediction"))
    twice = F.raise_error(F.concat(F.lit("two predictions for "), "case_id")).cast("string")
    return grouped.select("case_id", F.when(F.col("n") > 1, twice).otherwise(F.col("prediction")).alias("prediction"))


def markdown_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, front_matter, body) of Markdown files."""
    t = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(path, wholetext=True)
    head, body = X.front_matter(F.col("value"))
    return t.select(F.col("_metadata.file_path").alias("file_path"), head.alias("front_matter"), body.alias("body"))


def yaml_documents(spark: SparkSession, path: str, glob: str = "*.y*ml") -> DataFrame:
    """(file_path, nth, json, error): each document of multi-document YAML files as JSON text, parsed in Arrow batches."""
    import json

    import pandas as pd

    def parse(batches):
        import yaml

        for batch in batches:
            rows = []
            for name, content in zip(batch["file_path"], batch["value"]):
                try:
                    for n, doc in enumerate(yaml.safe_load_all(content)):
                        if doc is not None:
                            rows.append((name, n, json.dumps(doc, default=str), None))
                except yaml.YAMLError as e:
                    rows.append((name, 0, None, str(e)))
            yield pd.DataFrame(rows, columns=["file_path", "nth", "json", "error"])

    t = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return t.select(F.col("_metadata.file_path").alias("file_path"), "value").mapInPandas(parse, "file_path string, nth int, json string, error string")


def attack_ids(spark: SparkSession, path: str) -> DataFrame:
    """Technique ids of STIX bundles that are neither revoked nor deprecated."""
    schema = "objects array<struct<type:string,revoked:boolean,x_mitre_deprecated:boolean,external_references:array<struct<source_name:string,external_id:string>>>>"
    o = json_file(spark, path, schema).select(F.explode("objects").alias("o"))
    live = o.filter((F.col("o.type") == "attack-pattern") & ~F.coalesce("o.revoked", F.lit(False)) & ~F.coalesce("o.x_mitre_deprecated", F.lit(False)))
    ids = F.filter("o.external_references", lambda r: (r["source_name"] == "mitre-attack") & F.regexp_like(r["external_id"], F.lit(r"\AT\d{4}(\.\d{3})?\z")))
    return live.select(F.try_element_at(ids, F.lit(1))["external_id"].alias("id")).filter("id is not null").distinct()
