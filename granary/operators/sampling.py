"""Samplers, dedupes and orders as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.lineage import cut


def keep_first(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row of each key, the first in order; min_by-like, so no partition is sorted as a whole."""
    names = [c for c in rows.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_gr_n", F.row_number().over(w)).filter("_gr_n = 1").select(*keys, *names)


def keep_last(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return keep_first(rows, keys, [F.desc(c) if isinstance(c, str) else c.desc() for c in order])


def richness(words: Column) -> Column:
    return F.when(words < 250, 0).when(words < 750, 1).when(words < 2000, 2).otherwise(3)


def round_robin(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source of targets (source, target) up to target docs, one of each bucket a round.

    docs: doc_id, source, content_type, word_count. Buckets are (richness, content type), in that order, docs within
    by doc_id; a doc_id that occurs twice counts once. Adds place, the order of choice within the source.
    """
    docs = docs.join(F.broadcast(targets), "source").withColumn("bucket", richness(F.col("word_count")))
    turn = Window.partitionBy("source", "bucket", "content_type").orderBy("doc_id")
    place = Window.partitionBy("source").orderBy("turn", "bucket", "content_type")
    out = docs.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= F.col("target"))
    return out.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= F.col("target")).drop("turn", "bucket", "target")


def spot_check(rows: DataFrame, key: str, size: int = 100, seed: int = 1337) -> DataFrame:
    """size rows in an order hashed from the seed, numbered: the same at any partitioning."""
    order = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256)
    some = rows.withColumn("_gr_o", order).orderBy("_gr_o", key).limit(size)
    return some.withColumn("spot_check_id", F.format_string("spot-%03d", F.row_number().over(Window.orderBy("_gr_o", key)))).drop("_gr_o")


def top_k_restored(rows: DataFrame, group: list[str], score: list[Column], index: str, k: int) -> DataFrame:
    """The k rows of each group that score most, ties by index; order them by index again to restore the input's order."""
    w = Window.partitionBy(*group).orderBy(*score, index)
    return rows.withColumn("_gr_n", F.row_number().over(w)).filter(F.col("_gr_n") <= k).drop("_gr_n")


def numbered(rows: DataFrame, order: list, name: str, spread: int = 0) -> DataFrame:
    """rows with their global number from 1 in this order: ranges are sorted apart and their sizes added up."""
    parts = spread or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_gr_m", F.monotonically_increasing_id()))
    part = F.shiftright("_gr_m", 33)
    sizes = rows.groupBy(part.alias("_gr_p")).agg(F.count("*").alias("_gr_c"))
    before = sizes.withColumn("_gr_b", F.coalesce(F.sum("_gr_c").over(Window.orderBy("_gr_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_gr_c")
    out = rows.withColumn("_gr_p", part).join(F.broadcast(before), "_gr_p")  # one row a partition
    return out.withColumn(name, F.col("_gr_b") + F.col("_gr_m").bitwiseAND((1 << 33) - 1) + 1).drop("_gr_p", "_gr_m", "_gr_b")
