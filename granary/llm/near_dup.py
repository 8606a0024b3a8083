"""MinHash near-duplicates by SuperMinHash, banding, exact verification and union-find grouping.

Elements are hashes of ``SHINGLE`` consecutive words of the lower-cased text (all words as one element where there
are fewer). Each element walks its own permutation of the ``REGISTERS`` registers: at step j it offers the value
j + r to a register no earlier step of it has taken, so the ranks an element offers are correlated and the
signature varies less than that of independent hashes. A register that was offered something at step j can't be
bettered later, so a document stops as soon as all of its registers are filled; a text of hundreds of words ends
after two or three steps.

Documents with equal element sets are collapsed first; a class of copies is a representative and a membership.
Representatives meet where all registers of one of the ``BANDS`` bands are equal. Inside a bucket every member is
compared with its least member, and what that connects is grouped. A bucket whose members are in one group by then
is done. Of the others, those of up to ``FAN`` members have each pair from different groups compared; the members
of larger ones are compared by a prefix join, which is exact: a pair as similar as asked shares one of its rarest
elements, at places that leave enough elements to share. So every pair of a bucket is compared, connected already, or
proven less similar, whatever the bucket's size, and a hot bucket never meets as all of its pairs. Pairs are verified
by the exact Jaccard similarity of their sets of 64-bit elements. There is no cap on buckets, partners or groups.

At the threshold of 0.55 a pair is found with a probability of 0.98, at 0.6 of 0.996; one word changed in twenty
leaves a similarity of about 0.75, one in ten of about 0.57.

Nulls and edges: null, empty and wordless texts have no elements and are never grouped; rows with a null doc_id
are in no group (the filter keeps them); rows with one doc_id and equal texts are one document, the filter keeps
the one whose other columns sort first; rows with one doc_id and different texts share a group when either is near
something; very long texts are read whole; a group's least doc_id is kept, so ties don't arise; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from granary.llm import common as C
from granary.llm.components import components

SHINGLE = 3
BANDS = 40
ROWS = 4
REGISTERS = BANDS * ROWS
THRESHOLD = 0.55
#: Members of a bucket up to which pairs from different groups are compared directly; beyond, a prefix join finds them.
FAN = 64
U64 = np.uint64


def elements(raw: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct elements as (document number, hash), ordered by both."""
    _, _, doc, h = C.words(raw, offs)
    n = len(h)
    if not n:
        return doc, h
    per = np.bincount(doc, minlength=len(offs) - 1)
    first = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=first[1:])
    length = np.minimum(per, shingle)
    starts_per = np.where(per > 0, per - length + 1, 0)
    d, k = C.ragged(starts_per)
    s = first[d] + k
    e = C.span_hashes(h, s, s + length[d])
    order = np.lexsort((e, d))
    d, e = d[order], e[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (e[1:] != e[:-1])
    return d[new], e[new]


def superminhash(doc: np.ndarray, e: np.ndarray, docs: int, m: int = REGISTERS) -> np.ndarray:
    """Signatures [docs, m]: step in the high byte, random rank below; all ones for documents without elements."""
    sig = np.full(docs * m, ~U64(0))
    live = np.arange(len(e))
    past: list[np.ndarray] = []
    for j in range(m):
        if not len(live):
            break
        r = C.mix(e[live] ^ C.mix(np.full(1, j + 1, U64))[0])
        # Fisher-Yates: swap places j and k; what lies at k is traced back through the earlier swaps
        k = (j + (r >> U64(40)).astype(np.int64) % (m - j)).astype(np.int32)
        past.append(k)
        at = k.copy()
        for t in range(j - 1, -1, -1):
            at[past[t] == at] = t
        value = (U64(j) << U64(56)) | (C.mix(r) >> U64(8))
        np.minimum.at(sig, doc[live] * m + at, value)
        full = (sig.reshape(docs, m) != ~U64(0)).all(axis=1)  # early stop
        go = ~full[doc[live]]
        live = live[go]
        past = [p[go] for p in past]
    return sig.reshape(docs, m)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    key = np.zeros((len(sig), bands), U64) + np.arange(1, bands + 1, dtype=U64)
    for r in range(rows):
        key = C.mix(key * U64(0x9E3779B97F4A7C15) ^ sig[:, r::rows][:, :bands])
    return key


_SKETCH = "doc_id bigint, set_a bigint, set_b bigint, bands array<bigint>"


def _sets_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows that have elements, elements by row (ordered), and each row's number of them and two hashes of their set."""
    raw, offs = C.text_buffer(C.lower(part.column(1)))
    doc, e = elements(raw, offs)
    n = np.bincount(doc, minlength=part.num_rows)
    return np.flatnonzero(n), e, n[n > 0], doc


def _set_hashes(e: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    return np.add.reduceat(C.mix(e), first).view(np.int64), np.bitwise_xor.reduceat(C.mix(e ^ U64(0xA5A5A5A5A5A5A5A5)), first).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in C.steps(batch):
            has, e, n, doc = _sets_of(part)
            if not len(has):
                continue
            keys = band_keys(superminhash(np.repeat(np.arange(len(has)), n), e, len(has)))
            a, b = _set_hashes(e, n)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(has)).cast(pa.int64()), pa.array(a), pa.array(b), C.list_column(keys.reshape(-1).view(np.int64), np.full(len(has), BANDS), pa.int64())], names=["doc_id", "set_a", "set_b", "bands"]
            )


_ELEMENTS = "rep bigint, set_a bigint, n int, elements array<bigint>"


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in C.steps(batch):
            has, e, n, _ = _sets_of(part)
            if len(has):
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(has)).cast(pa.int64()), pa.array(_set_hashes(e, n)[0]), pa.array(n.astype(np.int32)), C.list_column(e.view(np.int64), n, pa.int64())], names=["rep", "set_a", "n", "elements"])


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) with their exact similarity where it reaches threshold."""
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("elements").alias("ea"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("elements").alias("eb"))
    both = pairs.join(left, "a").join(right, "b").filter(f"least(na, nb) >= {threshold} * greatest(na, nb)")
    shared = F.size(F.array_intersect("ea", "eb"))
    return both.withColumn("similarity", shared / (F.col("na") + F.col("nb") - shared)).filter(F.col("similarity") >= threshold).select("a", "b", "similarity")


def prefix_pairs(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of members (rep, root) with different roots, a superset of the pairs that reach threshold.

    Elements are ranked from the rarest among the members on. Sets of x and y elements, x <= y, that reach the
    threshold share ``t / (1 + t) * (x + y)`` at least, so an element among the first ``x - 2t / (1 + t) * x + 1`` of the one and
    the first ``y - t * y + 1`` of the other, and behind it there are enough left in both. Elements of one member alone
    are dropped before they meet.
    """
    rows = sets.join(members, "rep").select("rep", "set_a", "root", "n", F.explode("elements").alias("element"))
    often = rows.groupBy("element").agg(F.count("*").alias("df"))
    place = F.row_number().over(Window.partitionBy("rep", "set_a").orderBy("df", "element"))
    t = threshold
    least = lambda share: F.col("n") - F.ceil(share * F.col("n") - 1e-9) + 1
    ranked = rows.join(often, "element").withColumn("place", place).filter((F.col("place") <= least(t)) & (F.col("df") > 1))
    ranked = C.cut(ranked.select("element", "rep", "root", "n", "place", (F.col("place") <= least(2 * t / (1 + t))).alias("early")))
    x, y = (ranked.select("element", *[F.col(c).alias(f"{c}_{k}") for c in ("rep", "root", "n", "place", "early")]) for k in "xy")
    enough = f"1 + least(n_x - place_x, n_y - place_y) >= ceil({t / (1 + t)} * (n_x + n_y) - 1e-9)"
    met = x.filter("early_x").join(y, "element").filter(f"root_x <> root_y and n_x <= n_y and n_x >= {t} * n_y and {enough}")
    return met.select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def _grouped(edges: DataFrame) -> DataFrame:
    return C.cut(components(edges))


def similar_pairs(docs: DataFrame, threshold: float = THRESHOLD, fan: int = FAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, rep, copied) of all documents that have elements; groups of representatives (node, root) by what their
    buckets' least members are near to; and verified pairs (a, b, similarity) that join such groups."""
    rows = C.same_names(docs, "doc_id", "text").filter("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sketch = C.written(rows.mapInArrow(_sketch, _SKETCH))
    # combined before the shuffle, so a set that a third of all rows have isn't one task's
    alike = sketch.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    ids = C.cut(sketch.select("doc_id", "set_a", "set_b").join(alike, ["set_a", "set_b"]).select("doc_id", "rep", (F.col("rep") < F.col("last")).alias("copied")))
    reps = alike.select(F.col("rep").alias("doc_id"), "set_a", "set_b")
    banded = sketch.join(reps, ["doc_id", "set_a", "set_b"]).select(F.col("doc_id").alias("rep"), F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("rep").alias("centre"), F.max("rep").alias("far")).filter("centre < far").drop("far")
    met = C.cut(banded.join(shared, "bucket").distinct())
    found = met.select("rep").distinct()
    sets = C.written(rows.join(found, rows["doc_id"] == found["rep"], "left_semi").dropDuplicates(["doc_id", "text"]).mapInArrow(_elements, _ELEMENTS))
    star = met.filter("rep > centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    several = ids.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").drop("z")
    texts = ids.join(several, "doc_id").select("a", F.col("rep").alias("b"))  # of one doc_id
    roots = _grouped(_verified(star, sets, threshold).select("a", "b").union(texts))
    # buckets that hold members of several groups
    placed = met.select("bucket", "rep").join(roots, met["rep"] == roots["node"], "left").select("bucket", "rep", F.coalesce("root", "rep").alias("root"))
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")).filter("low < high").select("bucket", "members")
    placed = C.cut(placed.join(open_, "bucket"))
    few = placed.filter(F.col("members") <= fan)
    other = few.select("bucket", F.col("rep").alias("y"), F.col("root").alias("root_y"))
    direct = few.join(other, "bucket").filter("rep < y and root <> root_y").select(F.col("rep").alias("a"), F.col("y").alias("b")).distinct()
    many = placed.filter(F.col("members") > fan).select("rep", "root").distinct()
    return ids, roots, _verified(direct.union(prefix_pairs(many, sets, threshold)).distinct(), sets, threshold)


def near_duplicate_groups(docs: DataFrame, threshold: float = THRESHOLD, fan: int = FAN) -> DataFrame:
    """(doc_id, group_id, keep) for each document of a group of two or more; group_id is the least doc_id, which is kept."""
    ids, roots, pairs = similar_pairs(docs, threshold, fan)
    root_of = lambda key, to: roots.select(F.col("node").alias(key), F.col("root").alias(to))
    joined = pairs.join(root_of("a", "root_a"), "a", "left").join(root_of("b", "root_b"), "b", "left")
    joins = components(joined.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).distinct())
    joins = joins.select(F.col("node").alias("first"), F.col("root").alias("last"))
    found = ids.join(root_of("rep", "root"), "rep", "left").withColumn("first", F.coalesce("root", "rep")).join(joins, "first", "left")
    found = found.filter("copied or root is not null or last is not null").select("doc_id", F.coalesce("last", "first").alias("group_id"))
    return found.distinct().withColumn("keep", F.col("doc_id") == F.col("group_id"))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the members of groups that aren't kept, and with one row for rows of equal doc_id and text."""
    key, gone_, nth = (C.fresh(docs, c) for c in ("_gr_id", "_gr_gone", "_gr_nth"))
    gone = near_duplicate_groups(docs, threshold).filter("not keep").select(F.col("doc_id").alias(key), F.lit(True).alias(gone_))
    twice = C.same_names(docs, "doc_id").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("twice")).filter(F.col("twice") > 1).filter(F.col(key).isNotNull()).select(key, F.lit(False).alias(gone_))
    said = C.cut(gone.union(twice.join(gone, key, "left_anti")))
    marked = docs.join(C.broadcast_if_small(said, 16), docs["doc_id"] == F.col(key), "left")
    names = [docs[f"`{c}`"] for c in docs.columns]
    single = marked.filter(F.col(gone_).isNull()).select(*names)
    # rows whose doc_id occurs twice: one row for each text
    sortable = [docs[f"`{f.name}`"] for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    first = Window.partitionBy(docs["doc_id"], docs["text"]).orderBy(*sortable)
    double = marked.filter(~F.col(gone_)).withColumn(nth, F.row_number().over(first)).filter(F.col(nth) == 1).select(*names)
    return single.union(double)
