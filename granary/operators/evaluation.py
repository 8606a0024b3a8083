"""Scores of benchmark cases, scorecards, their comparison and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def case_scores(rows: DataFrame) -> DataFrame:
    """rows (case_id, task_type, score, max_points) with the score bounded and normalised."""
    bounded = F.greatest(F.lit(0.0), F.least(F.col("score"), F.col("max_points")))
    return rows.withColumns({"score": F.round(bounded, 4), "normalized_score": F.round(bounded / F.col("max_points"), 4)})


def scorecard(scores: DataFrame) -> DataFrame:
    """(task_type, cases, mean_score): a row for each task and, with a null task_type, one over all cases."""
    return scores.rollup("task_type").agg(F.count("*").alias("cases"), F.round(F.avg("normalized_score"), 4).alias("mean_score"))


def running(scores: DataFrame, run: str = "run", order: str = "nth") -> DataFrame:
    """The mean so far after each case of each run: what a checkpoint holds."""
    w = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return scores.withColumn("cases_so_far", F.count("*").over(w)).withColumn("mean_so_far", F.round(F.avg("normalized_score").over(w), 4))


def compared(base: DataFrame, tuned: DataFrame, most_loss: float = 0.05) -> DataFrame:
    """Both scorecards side by side; ``compatible`` is false for a task that one of them lacks."""
    x = base.select(F.coalesce("task_type", F.lit("(all)")).alias("task_type"), F.col("mean_score").alias("baseline"))
    y = tuned.select(F.coalesce("task_type", F.lit("(all)")).alias("task_type"), F.col("mean_score").alias("tuned"))
    delta = F.col("tuned") - F.col("baseline")
    both = x.join(y, "task_type", "full")
    return both.select("task_type", "baseline", "tuned", F.round(delta, 4).alias("delta"), ((F.col("task_type") != "(all)") & (delta < -most_loss)).alias("regressed"), (F.col("baseline").isNotNull() & F.col("tuned").isNotNull()).alias("compatible"))


def gate(comparison: DataFrame, least_gain: float = 0.0) -> DataFrame:
    """One row: whether the tuned run passes, and the tasks it fails."""
    gain = F.max(F.when(F.col("task_type") == "(all)", F.col("tuned") - F.col("baseline")))
    worse = F.array_join(F.array_sort(F.collect_list(F.when(F.col("regressed"), F.col("task_type")))), ",")
    return comparison.agg(F.round(gain, 4).alias("overall_delta"), worse.alias("severe"), ((gain > least_gain) & ~F.bool_or("regressed") & F.bool_and("compatible")).alias("passes"))


def fingerprint(rows: DataFrame, key: str, content: Column) -> DataFrame:
    """SHA-256 over all rows' contents in key order: rows are digested first, so one digest a row is gathered."""
    each = rows.select(F.col(key).alias("k"), F.sha2(content, 256).alias("d"))
    return each.agg(F.count("*").alias("cases"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "d"))), lambda x: x["d"]), ","), 256).alias("fingerprint"))


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def judged(rows: DataFrame, answer: str = "answer") -> DataFrame:
    """rows (max_points, answer: JSON text) with the judge's verdict and what is wrong with it, null if nothing."""
    v = F.from_json(F.col(answer), "score double, reason string, criteria map<string, double>")
    bad = (
        F.when(v.isNull() | v["score"].isNull(), "no score").when((v["score"] < 0) | (v["score"] > F.col("max_points")), "score out of range")
        .when(F.coalesce(F.trim(v["reason"]), F.lit("")) == "", "no reason").when(~F.coalesce(F.forall(F.map_values(v["criteria"]), lambda x: (x >= 0) & (x <= 1)), F.lit(True)), "criterion out of range")
    )
    return rows.withColumns({"verdict_score": v["score"], "problem": bad})


def messages(system: str, context: Column, prompt: Column, instruction: Column | None = None, heading: bool = True) -> Column:
    """A case as chat messages; parts that are null or empty are left out."""
    stripped = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    first = F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit("Context:\n" if heading else ""), stripped(context)))
    parts = [first, F.concat(F.lit("Question:\n"), stripped(prompt))] + ([F.when(instruction != "", instruction)] if instruction is not None else [])
    user = F.array_join(F.array_compact(F.array(*parts)), "\n\n")
    make = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(make("system", F.lit(system)), make("user", user)) if system else F.array(make("user", user))


def judge_messages(rubric: str, question: Column, expected: Column, prediction: Column, max_points: Column) -> Column:
    """What a judge gets: the rubric as the system's message, and the case with the answer as one JSON text."""
    payload = F.to_json(F.struct(question.alias("question"), expected.alias("expected"), prediction.alias("prediction"), max_points.alias("max_points")))
    make = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(make("system", F.lit(rubric)), make("user", payload))


def incompatible(base: DataFrame, tuned: DataFrame, fields: list[str], case: str = "case_id") -> DataFrame:
    """(problem) for all that forbids comparing two runs' case scores: cases of one run alone, or fields that differ."""
    a, b = base.select(case, *fields), tuned.select(case, *[F.col(f).alias(f"_gr_{f}") for f in fields])
    both = a.withColumn("_gr_a", F.lit(True)).join(b.withColumn("_gr_b", F.lit(True)), case, "full")
    problems = F.array_compact(F.array(F.when(F.col("_gr_a").isNull() | F.col("_gr_b").isNull(), F.lit("cases differ")), *[F.when(F.col("_gr_a") & F.col("_gr_b") & ~F.col(f).eqNullSafe(F.col(f"_gr_{f}")), F.lit(f"{f} differs")) for f in fields]))
    return both.select(F.explode(problems).alias("problem")).distinct()


def predicted(cases: DataFrame, predictions: DataFrame, key: str = "case_id") -> DataFrame:
    """Cases with their predictions; a case without one is an error when it is read."""
    missing = F.raise_error(F.concat(F.lit("no prediction for "), F.col(key).cast("string"))).cast("string")
    p = predictions.select(key, F.col("prediction").alias("_gr_p"))
    out = cases.join(p, key, "left")
    return out.withColumn("prediction", F.when(F.col("_gr_p").isNull(), missing).otherwise(F.col("_gr_p"))).drop("_gr_p")
