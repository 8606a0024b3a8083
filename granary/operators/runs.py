"""Generation runs: what is left to do, when to stop, and what the corpus and the answers look like."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def left_to_do(plan: DataFrame, accepted: DataFrame, rejected: DataFrame, model: str) -> DataFrame:
    """Prompts that no finished row matches by id, hash and model."""
    done = accepted.select("prompt_id", "prompt_hash", "model").unionByName(rejected.select("prompt_id", "prompt_hash", "model")).filter(F.col("model") == model)
    return plan.join(done.select("prompt_id", "prompt_hash").distinct(), ["prompt_id", "prompt_hash"], "left_anti")


def tripped(attempts: DataFrame, order: list[str], rejected: Column, least: int = 20, rate: float = 0.2, bucket: str | None = None) -> DataFrame:
    """One row: after how many attempts (null: never) the share of rejected ones reaches rate, and how many were rejected.

    Cumulative counts are made in two levels, over ranges of the order and then within each, so no task sees all rows.
    """
    from granary.operators.sampling import numbered

    rows = numbered(attempts.select(*order, rejected.cast("int").alias("_gr_bad")), order, "nth")
    size = 1 << 16
    block = F.floor((F.col("nth") - 1) / size)
    sums = rows.groupBy(block.alias("_gr_k")).agg(F.sum("_gr_bad").alias("_gr_s"))
    before = sums.select("_gr_k", F.coalesce(F.sum("_gr_s").over(Window.orderBy("_gr_k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_gr_b"))
    w = Window.partitionBy("_gr_k").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    so_far = rows.withColumn("_gr_k", block).join(before, "_gr_k").withColumn("bad", F.col("_gr_b") + F.sum("_gr_bad").over(w))
    hit = so_far.filter((F.col("nth") >= least) & (F.col("bad") / F.col("nth") >= rate))
    return hit.agg(F.min("nth").alias("tripped_at"), F.min_by("bad", "nth").alias("rejected"))


def duplicates(docs: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of docs whose key was seen before in this order, with the place where it was first."""
    w = Window.partitionBy(key).orderBy(*order)
    out = docs.withColumn("_gr_n", F.row_number().over(w)).withColumns({f"first_{c}": F.first(c).over(w) for c in order})
    return out.filter("_gr_n > 1").drop("_gr_n")


def corpus_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("source").agg(F.count("*").alias("docs"), F.countDistinct("doc_id").alias("distinct_docs"))


def acceptance(pairs: DataFrame) -> DataFrame:
    """Prompts with the number of their pairs and issues; a prompt is accepted as a whole or not at all.

    pairs: prompt_id, requested, issues (array; null where the answer was no JSON list).
    """
    g = pairs.groupBy("prompt_id").agg(F.first("requested").alias("requested"), F.count("issues").alias("pairs"), F.sum(F.size(F.coalesce("issues", F.array().cast("array<string>")))).alias("problems"))
    return g.withColumn("accepted", (F.col("pairs") == F.col("requested")) & (F.col("problems") == 0))


def retry_prompt(prompt: Column, issues: Column, most: int = 12) -> Column:
    """The prompt again, followed by the issues that the last answer had."""
    listed = F.array_join(F.transform(F.slice(issues, 1, most), lambda x: F.concat(F.lit("- "), x)), "\n")
    more = F.when(F.size(issues) > most, F.format_string("\n- and %d more", F.size(issues) - most)).otherwise("")
    return F.concat(prompt, F.lit("\n\nThe last answer had these problems:\n"), listed, more)


def generated(prompts: DataFrame, client: Callable[[str], str], check: Callable[[str], str | None], attempts: int = 3) -> DataFrame:
    """(prompt_id, answer, attempts, problem) of calling client with each prompt until check finds no problem.

    The client is called on the executors; give one that can be pickled. Its errors count as problems.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, prompt in zip(batch["prompt_id"], batch["prompt"]):
                problem, answer, n, text = "not called", None, 0, prompt
                while n < attempts and problem is not None:
                    n += 1
                    try:
                        answer = client(text)
                        problem = check(answer)
                    except Exception as e:  # noqa: BLE001
                        problem = repr(e)
                    text = f"{prompt}\n\nThe last answer had this problem: {problem}"
                rows.append((key, answer, n, problem))
            yield pd.DataFrame(rows, columns=["prompt_id", "answer", "attempts", "problem"])

    return prompts.select("prompt_id", "prompt").mapInPandas(run, "prompt_id string, answer string, attempts int, problem string")


def pairs_per_document(words: Column, configured: Column, thin: Column, most: Column) -> Column:
    """One below 250 words; else as configured, at most two of a thin source and at most the content type's bound."""
    n = F.least(configured, F.when(thin, 2), most)
    return F.when(words < 250, 1).otherwise(n)


def prompt_text(template: str, values: dict[str, Column]) -> Column:
    """The template with each $name of values filled in; others stay."""
    import re

    parts, at = [], 0
    for m in re.finditer(r"\$(?:\{(\w+)\}|(\w+))", template):
        name = m[1] or m[2]
        if name in values:
            parts += [F.lit(template[at : m.start()]), F.coalesce(values[name].cast("string"), F.lit(""))]
            at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def taxonomy_refs(*groups: Column, fallback: Column, default: str = "S1", most: int = 3) -> Column:
    """The first refs of all groups in order; those of fallback where there are none, default where that has none."""
    refs = F.array_distinct(F.concat(*[F.coalesce(g, F.array().cast("array<string>")) for g in groups]))
    other = F.coalesce(fallback, F.array().cast("array<string>"))
    refs = F.when(F.size(refs) > 0, refs).when(F.size(other) > 0, F.array_distinct(other)).otherwise(F.array(F.lit(default)))
    return F.slice(refs, 1, most)


def policy_problems(difficulties: dict, categories: dict[str, str | None], profiles: dict[str, list[str]]) -> list[str]:
    """What is wrong with a prompt policy: difficulty weights, category templates, and the categories of source profiles."""
    out = []
    bad = [k for k, v in difficulties.items() if not isinstance(v, (int, float)) or isinstance(v, bool) or v < 0]
    out += [f"weight of {k} is no number from 0" for k in bad]
    if {"junior", "mid", "senior"} - set(difficulties):
        out.append("a difficulty has no weight")
    elif not bad and sum(difficulties.values()) <= 0:
        out.append("weights add up to nothing")
    out += [f"{k} has no template" for k, v in categories.items() if not v]
    out += [f"{source} has no category" for source, names in profiles.items() if not names]
    return out + [f"{source}: unknown category {c}" for source, names in profiles.items() for c in names if c not in categories]


def breaker_problem(mode: str, least: int, rate: float) -> str | None:
    """What is wrong with the circuit breaker's arguments; modes without one accept any."""
    if mode not in ("full", "subset"):
        return None
    return "least must be 1 or more" if least < 1 else "rate must be above 0 and at most 1" if not 0 < rate <= 1 else None


def too_long(rows: DataFrame, tokens: str, most: int) -> DataFrame:
    """Training rows beyond a token limit; counts come from an encoding operator or any other column."""
    return rows.filter(F.col(tokens) > most)


def teacher_log(answers: DataFrame, run_id: str, path: str) -> None:
    """Append a batch of raw answers to the run's log table."""
    answers.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def checkpointed(cases: DataFrame, done_path: str, score: Callable[[DataFrame], DataFrame], key: str = "case_id") -> DataFrame:
    """Score the cases that the table at done_path lacks and append them in one commit; all scores so far."""
    spark = cases.sparkSession
    try:
        done = spark.read.parquet(done_path)
        left = cases.join(done.select(key), key, "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        left = cases
    score(left).write.mode("append").parquet(done_path)
    return spark.read.parquet(done_path)
