"""From raw documents to encoded training data, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents, whatever those are named.

Nulls and edges: a row with a null or empty text passes the quality rules by its score like any other, is in no group
of near duplicates, holds no personal data, is copied as its source's weight has it and has no pieces; a row with a
null doc_id passes the same way, ungrouped; very long texts are handled whole in every stage; of equal rows one
stays; ties are as the stages' operators have them; an empty table gives no rows. Extra columns are carried up to the
last stage, which names its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from granary.lineage import passing, remove
from granary.llm import common, mixing, near_dup, pieces, pii, quality

#: SQL can't express the trees, the signatures' groups, the tagging or the encoding; tests compare with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that the boosted trees reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all that are in none."""
    return near_dup.keep_one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All docs, personal data in their texts replaced by its type."""
    return pii.masked(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight has it drawn, in a global random order."""
    copy = common.fresh(docs, "_gr_copy")
    return mixing.replicate(docs, copy=copy).drop(copy)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, tokens, round_trip of every row."""
    return pieces.encoded(docs, carried=("source",))


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", source_mix), ("encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{common.shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        with passing(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
