"""The gate over a whole dataset: issues that only all rows together show, added to those that each row has by itself.

Each gate adds an issue to the rows it finds and their status is recomputed: filtered, then review, then rejected, never
back. Near duplicates come first, among rows that aren't rejected; then the balance of sources, among those that are
still filtered; then the audits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.lineage import cut
from granary.operators import balance, neardup
from granary.operators import reasoning as R
from granary.operators.rules import status


def with_issue(rows: DataFrame, test: Column, issue: Column) -> DataFrame:
    """rows with the issue added where the test holds, and their status recomputed."""
    rows = rows.withColumn("issues", F.when(F.coalesce(test, F.lit(False)), F.concat("issues", F.array(issue).cast(R.ISSUE))).otherwise(F.col("issues")))
    return rows.withColumn("quality_status", status(F.col("issues")))


def record_tokens(instruction: Column, answer: Column) -> Column:
    """What a training pair is compared by: the distinctive tokens of its instruction and its final answer."""
    return X.distinctive_tokens(F.concat_ws("\n", instruction, answer))


def near_duplicates(rows: DataFrame, key: str, threshold: float = neardup.THRESHOLD) -> DataFrame:
    """decided rows with ``duplicate_or_near_duplicate`` added to those near a kept row of a higher score, ties by key."""
    eligible = rows.filter("quality_status <> 'rejected'")
    rank = F.struct((-F.coalesce("score_total", F.lit(0.0))).alias("s"), F.col(key).alias("k"))
    compared = eligible.select(F.col(key).alias("key"), rank.alias("rank"), record_tokens(F.col("instruction"), F.col("final_answer")).alias("tokens"))
    gone = neardup.dropped_rows(compared, threshold, neardup.LEAST_TOKENS).select(F.col("key").alias("_gr_key"), "kept_key")
    joined = rows.join(gone, F.col(key) == F.col("_gr_key"), "left")
    message = F.concat(F.lit("near duplicate of "), F.col("kept_key").cast("string"))
    return with_issue(joined, F.col("_gr_key").isNotNull(), R.issue("duplicate_or_near_duplicate", "reject", message)).drop("_gr_key", "kept_key")


def source_balance(rows: DataFrame, key: str, group: str = "source", share: float = 0.25) -> DataFrame:
    """rows with ``source_overrepresented`` added to the filtered ones of least score beyond their source's share."""
    filtered = rows.filter("quality_status = 'filtered'").select(group, "score_total", F.col(key).alias("_gr_key"))
    over = balance.over_represented(filtered, group, ["score_total", "_gr_key"], share).filter("surplus").select("_gr_key")
    joined = rows.join(over, F.col(key) == F.col("_gr_key"), "left")
    message = F.concat(F.lit("beyond the share of source "), F.coalesce(F.col(group).cast("string"), F.lit("<missing>")))
    return with_issue(joined, F.col("_gr_key").isNotNull(), R.issue("source_overrepresented", "review", message)).drop("_gr_key")


def gated(rows: DataFrame, key: str, group: str = "source", share: float = 0.25, threshold: float = neardup.THRESHOLD) -> DataFrame:
    """decided rows after both gates. The rows' own rules are evaluated once; a gate's outcome is written before the next."""
    return source_balance(cut(near_duplicates(cut(rows), key, threshold)), key, group, share)


def manifest(rows: DataFrame) -> DataFrame:
    """(part, name, n) of a gated run: rows by status, issues by code and status, and filtered rows by source."""
    by_status = rows.groupBy(F.lit("status").alias("part"), F.col("quality_status").alias("name")).agg(F.count("*").alias("n"))
    issues = rows.select("quality_status", F.explode("issues").alias("i")).groupBy(F.lit("issue").alias("part"), F.concat_ws(":", "quality_status", "i.code").alias("name")).agg(F.count("*").alias("n"))
    sources = rows.filter("quality_status = 'filtered'").groupBy(F.lit("source").alias("part"), F.coalesce(F.col("source").cast("string"), F.lit("<missing>")).alias("name")).agg(F.count("*").alias("n"))
    return by_status.unionByName(issues).unionByName(sources)
