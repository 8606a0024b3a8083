"""Union-find grouping of an edge table, distributed.

Edges first shrink to spanning forests by a union-find inside each partition; alternating large-star and
small-star rounds then hang every node under the least id of its component. Each round is two shuffles of the
edges left, and their lineage is cut by a checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common as C

#: Edges that a task holds at once; each lot shrinks to a spanning forest of its own.
FOREST = 1 << 20


def find(parent: dict[int, int], x: int) -> int:
    root = x
    while parent.get(root, root) != root:
        root = parent[root]
    while parent.get(x, x) != root:
        parent[x], x = root, parent[x]
    return root


def union_pairs(a: list[int], b: list[int]) -> dict[int, int]:
    """Node to the least node of its component."""
    parent: dict[int, int] = {}
    for x, y in zip(a, b):
        x, y = find(parent, x), find(parent, y)
        if x != y:
            parent[max(x, y)] = min(x, y)
        parent.setdefault(x, x)
        parent.setdefault(y, y)
    return {x: find(parent, x) for x in parent}


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for batch in batches:
        a += batch.column(0).to_pylist()
        b += batch.column(1).to_pylist()
        if len(a) > FOREST:
            yield _spanning(a, b)
            a, b = [], []
    yield _spanning(a, b)


def _spanning(a: list[int], b: list[int]) -> pa.RecordBatch:
    of = union_pairs(a, b)
    node = np.fromiter(of.keys(), np.int64, len(of))
    root = np.fromiter(of.values(), np.int64, len(of))
    keep = node != root
    return pa.RecordBatch.from_arrays([pa.array(root[keep]), pa.array(node[keep])], names=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    if large:  # larger neighbours of u hang under the least of u and its neighbours
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:  # u and its smaller neighbours hang under the least of them
        small = both.filter("v < u")
        least = small.groupBy("u").agg(F.min("v").alias("m"))
        out = small.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).union(least.select("m", "u"))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b), root the least id of its component and a row for the root too."""
    now = C.cut(edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a <> b").mapInArrow(_forest, "a bigint, b bigint"))
    mark = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark or not new[0]:
            break
        mark = new
        now = C.cut(_star(_star(now, True), False))
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select("a", "a").distinct())
