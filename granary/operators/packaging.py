"""Chat records of accepted candidates, their model-specific views, and the contract they are held to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text as X

OPEN, CLOSE, OTHER_OPEN, OTHER_CLOSE, ANNOTATION = "<reasoning>", "</reasoning>", "<think>", "</think>", "[GENERAL KNOWLEDGE]"


def response_view(response: Column, style: Column) -> Column:
    """The whole response, or for direct style its final answer; a direct response without one is an error."""
    answer = X.final_answer(response)
    bad = F.raise_error(F.lit("a direct response has no final answer")).cast("string")
    return F.when(style != "direct", X.strip(response)).when(answer == "", bad).otherwise(answer)


def model_view(content: Column, drop_annotation: bool = True, other_tags: bool = True) -> tuple[Column, Column]:
    """The content as one model wants it, and the names of the changes that applied."""
    marks, out = [], content
    if drop_annotation:
        marks.append(F.when(F.contains(content, F.lit(ANNOTATION)), F.lit("annotations removed")))
        out = F.replace(out, F.lit(ANNOTATION), F.lit(""))
    if other_tags:
        marks.append(F.when(F.contains(content, F.lit(OPEN)) | F.contains(content, F.lit(CLOSE)), F.lit("tags swapped")))
        out = F.replace(F.replace(out, F.lit(OPEN), F.lit(OTHER_OPEN)), F.lit(CLOSE), F.lit(OTHER_CLOSE))
    return X.trimmed_lines(out), F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")


def packaged(rows: DataFrame, system: str, number: str, style: str = "style", **view: bool) -> DataFrame:
    """id, messages and metadata of each row; number is the row's place in the input, from 1."""
    content, changes = model_view(response_view(F.col("response"), F.col(style)), **view)
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    rest = [c for c in rows.columns if c not in ("instruction", "response", number, style)]
    meta = F.struct(*rest, F.col(style).alias("reasoning_style"), changes.alias("model_transforms"), F.concat_ws(":", "prompt_id", F.col("pair_index").cast("string")).alias("source_pair_key"))
    messages = F.array(message("system", F.lit(system.strip())), message("user", X.strip(F.col("instruction"))), message("assistant", content))
    return rows.select(F.format_string("record-%06d", number).alias("id"), messages.alias("messages"), meta.alias("metadata"))


def violations(records: DataFrame, drop_annotation: bool = True, other_tags: bool = True) -> DataFrame:
    """(id, problem) for all that breaks the contract; no rows means that the records may be written."""
    roles = F.transform("messages", lambda m: m["role"])
    answer = F.element_at("messages", 3)["content"]
    own = F.transform(X.lines(answer), X.strip)
    want, wrong = ((OTHER_OPEN, OTHER_CLOSE), (OPEN, CLOSE)) if other_tags else ((OPEN, CLOSE), (OTHER_OPEN, OTHER_CLOSE))
    style = F.col("metadata.reasoning_style")
    expected = F.when(style == "reasoning", 1).otherwise(0)
    count = lambda tag: F.size(F.filter(own, lambda x: x == tag))
    source = F.coalesce(F.col("metadata.source_doc_id").cast("string"), F.lit(""))
    problems = [
        F.when(F.array_join(roles, ",") != "system,user,assistant", "roles"),
        F.when(F.exists("messages", lambda m: F.coalesce(X.strip(m["content"]), F.lit("")) == ""), "empty message"),
        F.when((source == "") | (source == "unknown"), "no source document"),
        F.when(~style.isin("reasoning", "direct"), "style"),
        F.when(F.contains(answer, F.lit(ANNOTATION)), "annotation left") if drop_annotation else F.lit(None).cast("string"),
        F.when((count(want[0]) != expected) | (count(want[1]) != expected), "tags"),
        F.when(F.exists(own, lambda x: x.isin(*wrong)), "another model's tags"),
    ]
    return records.select("id", F.explode(F.array_compact(F.array(*problems))).alias("problem"))


def split_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("records"), F.countDistinct("source_doc_id").alias("source_docs"))


def style_summary(rows: DataFrame) -> DataFrame:
    """Counts of styles and their fractions of all rows."""
    counts = rows.groupBy("style").agg(F.count("*").alias("n"))
    total = counts.agg(F.greatest(F.sum("n"), F.lit(1)).alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("style", "n", F.round(F.col("n") / F.col("total"), 4).alias("fraction"))
