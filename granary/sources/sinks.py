"""Writers: one table by status or split, appended logs, and small reports that replace their predecessor at once."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from granary.functions import text as X


def json_lines(rows: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Rows as JSON lines in ASCII, and how many; one pass, counted as it writes."""
    seen = Observation()
    text = rows.select(ascii_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("value"))
    text.observe(seen, F.count("*").alias("n")).write.mode(mode).text(path)
    return seen.get["n"]


def ascii_json(row: Column) -> Column:
    """A struct as JSON whose characters beyond ASCII are escaped, as pairs of surrogates where they need two."""
    made = F.to_json(row, {"ignoreNullFields": "false"})
    escaped = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", "\\\\u$1")
    plain = ~F.regexp_like(made, F.lit(r"[^\x00-\x7f]"))
    return F.when(plain, made).otherwise(F.array_join(F.transform(F.regexp_extract_all(made, F.lit(r"(?s)([\x00-\x7f]+|.)"), F.lit(1)), lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(escaped(x))), ""))


def append_json(rows: DataFrame, path: str) -> int:
    """Rows added to those at path in one commit, and how many; a stream of single rows is batched by its caller."""
    return json_lines(rows, path, "append")


def corpus(docs: DataFrame, path: str) -> None:
    """Documents as Parquet by source; a source that is written again replaces its own folder alone."""
    docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def by_status(rows: DataFrame, path: str, run_id: str | None = None, status: str = "quality_status") -> dict[str, dict[str, int]]:
    """Rows by status in one pass, and the run's counters: rows by status, issues of reviewed and of rejected rows by
    code, and filtered rows by source, category and difficulty, as far as rows have those columns.

    Counters are added up from the written rows, of which only the small columns are read.
    """
    if run_id is not None:
        rows = rows.withColumn("quality_run_id", F.lit(run_id))
    rows.write.mode("overwrite").partitionBy(status).json(path)
    back = rows.sparkSession.read.schema(rows.schema).json(path)
    kept = F.col(status) == "filtered"
    pairs = [F.array(F.struct(F.lit("status").alias("part"), F.col(status).alias("name")))]
    for c in ("source", "category", "difficulty"):
        if c in rows.columns:
            pairs.append(F.when(kept, F.array(F.struct(F.lit(c).alias("part"), F.coalesce(F.col(c).cast("string"), F.lit("<missing>")).alias("name")))))
    if "taxonomy_refs" in rows.columns:
        pairs.append(F.when(kept, F.transform("taxonomy_refs", lambda x: F.struct(F.lit("taxonomy").alias("part"), x.alias("name")))))
    if "issues" in rows.columns:
        pairs.append(F.when(~kept, F.transform("issues", lambda x: F.struct(F.concat(F.lit("issues of "), F.col(status)).alias("part"), x["code"].alias("name")))))
    empty = F.array().cast("array<struct<part:string,name:string>>")
    each = back.select(F.explode(F.concat(*[F.coalesce(p.cast("array<struct<part:string,name:string>>"), empty) for p in pairs])).alias("x")).groupBy("x.part", "x.name").count()
    found: dict[str, dict[str, int]] = {}
    for part, name, n in each.orderBy("part", "name").collect():  # one row for each status, code, source, category
        found.setdefault(part, {})[name] = n
    return found


def by_split(rows: DataFrame, path: str, split: str = "split") -> None:
    rows.write.mode("overwrite").partitionBy(split).json(path)


def report(rows: DataFrame, path: str, most: int = 10_000) -> int:
    """A small result as one JSON file, written beside the old one and put in its place at once; more rows are an error."""
    found = [r.asDict(recursive=True) for r in rows.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} rows: write them with Spark")
    fd, name = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(fd, "w") as f:
        json.dump(found, f, indent=2, default=str)
    os.replace(name, path)
    return len(found)


def markdown(comparison: DataFrame, gate: DataFrame) -> str:
    """A comparison of two scorecards as Markdown."""
    g = gate.first()
    head = [f"# Comparison\n\nOverall change: {g['overall_delta']:+.4f}. {'Passes.' if g['passes'] else 'Fails.'}\n", "| task | baseline | tuned | change |", "|---" * 4 + "|"]
    rows = comparison.filter(F.col("task_type") != "(all)").orderBy("task_type").collect()
    return "\n".join([*head, *[f"| {r['task_type']} | {r['baseline']:.4f} | {r['tuned']:.4f} | {r['delta']:+.4f}{' (worse)' if r['regressed'] else ''} |" for r in rows]])


def prompt_render(prompts: DataFrame, path: str, config: str = "", one_each: bool = False) -> dict:
    """A dry run: prompts (prompt_id, prompt, ...) as JSON lines, on demand also one Markdown file each, and the manifest.

    Files of their own are partitions named by the prompt's safe file name, written by the executors.
    """
    n = json_lines(prompts, f"{path}/prompts")
    if one_each:
        named = prompts.select(X.slug(F.col("prompt_id"), "prompt").alias("file"), F.col("prompt").alias("value"))
        named.write.mode("overwrite").partitionBy("file").option("compression", "none").text(f"{path}/files")
    manifest = {"mode": "dry_run", "model": "none", "prompt_count": n, "config_path": config, "output_dir": path, "notes": ["No model was called."]}
    spark = prompts.sparkSession
    spark.createDataFrame([(json.dumps(manifest, indent=2),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


def evaluation_checkpoint(predictions: DataFrame, scores: DataFrame, scorecard: DataFrame, path: str, settings: dict) -> dict[str, int]:
    """The four outputs of a run so far, each replaced in one commit: predictions, case scores, scorecard, settings."""
    counts = {"predictions": json_lines(predictions, f"{path}/predictions"), "scores": json_lines(scores, f"{path}/scores"), "scorecard": json_lines(scorecard, f"{path}/scorecard")}
    spark = scores.sparkSession
    spark.createDataFrame([(json.dumps(settings | counts, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/run")
    return counts
