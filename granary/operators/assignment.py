"""Assignments that look at what was assigned before: splits by group, categories by deficit, response styles.

A greedy choice needs its predecessors. Splits depend on group sizes alone, so the fold runs over the histogram of
sizes and only its run-length coded outcome travels back. Categories depend on every row's allowed set; that fold
streams the sorted rows through one task in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.values import hash_bucket
from granary.lineage import cut

SPLITS = ("train", "validation", "test")


def split_targets(total: int, train: float = 0.8, validation: float = 0.1) -> list[int]:
    a, b = round(total * train), round(total * validation)
    return [a, b, total - a - b]


def split_runs(histogram: list[tuple[int, int]], targets: list[int]) -> list[tuple[int, int, int, str]]:
    """(size, from, to, split): where the groups of each size go, largest size first, numbered from 1 within it."""
    left = list(targets)
    scale = [max(t, 1) for t in targets]
    runs: list[tuple[int, int, int, str]] = []
    for size, count in sorted(histogram, reverse=True):
        for k in range(1, count + 1):
            s = max(range(3), key=lambda i: (left[i] / scale[i], left[i], -i))
            left[s] -= size
            if runs and runs[-1][0] == size and runs[-1][3] == SPLITS[s]:
                runs[-1] = (*runs[-1][:2], k, SPLITS[s])
            else:
                runs.append((size, k, k, SPLITS[s]))
    return runs


def splits(rows: DataFrame, group: str, train: float = 0.8, validation: float = 0.1, seed: int = 1337) -> DataFrame:
    """(group, n, split): all rows of a group in one split, groups of a size in an order hashed from the seed."""
    spark = rows.sparkSession
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string")), 256)
    groups = cut(rows.groupBy(group).agg(F.count("*").alias("n")).withColumn("_gr_nth", F.row_number().over(Window.partitionBy("n").orderBy(order, group))))
    histogram = [(r[0], r[1]) for r in groups.groupBy("n").count().collect()]  # one row for each size
    runs = split_runs(histogram, split_targets(sum(s * c for s, c in histogram), train, validation))
    table = spark.createDataFrame(pd.DataFrame(runs or [(0, 0, 0, "")], columns=["_gr_size", "_gr_from", "_gr_to", "split"]))
    return groups.join(table, (F.col("n") == F.col("_gr_size")) & F.col("_gr_nth").between(F.col("_gr_from"), F.col("_gr_to"))).select(group, "n", "split")


def leakage(assigned: DataFrame, key: str) -> DataFrame:
    """(a, b, n): keys that two splits share; no rows where there is no leak."""
    each = assigned.select(key, "split").distinct()
    x, y = each.select(key, F.col("split").alias("a")), each.select(key, F.col("split").alias("b"))
    return x.join(y, key).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))


def categories(docs: DataFrame, targets: dict[str, float]) -> DataFrame:
    """(doc_id, category): docs (doc_id, source, pairs, allowed) in order of their number of allowed categories.

    Each goes to the allowed category that lacks most pairs; of equals the one of least hash of doc and category.
    """
    share = sum(targets.values())
    total = docs.agg(F.sum("pairs")).first()[0] or 0
    want = {c: total * (w / share) for c, w in targets.items()}
    usable = F.filter("allowed", lambda c: c.isin(list(want)))
    jitter = F.transform(F.when(F.size(usable) > 0, usable).otherwise(F.col("allowed")), lambda c: F.struct(c.alias("c"), hash_bucket(F.concat_ws(":", F.col("doc_id").cast("string"), c), 10_000).alias("j")))
    rows = docs.select("doc_id", "source", "pairs", F.size("allowed").alias("k"), hash_bucket(F.col("doc_id").cast("string"), 1_000_000).alias("h"), jitter.alias("options"))
    one = rows.repartition(1).sortWithinPartitions("k", "h", "source", "doc_id")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: dict[str, int] = {}
        for batch in batches:
            chosen = []
            for pairs, options in zip(batch["pairs"], batch["options"]):
                best = max(options, key=lambda o: (want.get(o["c"], 0.0) - done.get(o["c"], 0), -o["j"]))["c"]
                done[best] = done.get(best, 0) + int(pairs)
                chosen.append(best)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "category": chosen})

    return one.select("doc_id", "pairs", "options").mapInPandas(fold, "doc_id bigint, category string")


def styles(rows: DataFrame, key: str, direct: float = 0.25, seed: int = 1337) -> DataFrame:
    """rows with ``style``: round(n * direct) of them direct, those first in an order hashed from the seed."""
    if not 0 <= direct <= 1:
        raise ValueError("fractions must be between 0 and 1")
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)
    marked = rows.withColumn("_gr_o", order)
    n = round(marked.count() * direct)
    last = marked.select("_gr_o", key).orderBy("_gr_o", key).offset(n - 1).limit(1) if n else None
    if last is None:
        return rows.withColumn("style", F.lit("reasoning"))
    edge = last.first()
    first = (F.col("_gr_o") < edge[0]) | ((F.col("_gr_o") == edge[0]) & (F.col(key) <= edge[1]))
    return marked.withColumn("style", F.when(first, "direct").otherwise("reasoning")).drop("_gr_o")
