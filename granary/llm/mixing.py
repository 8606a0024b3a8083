"""Mixing sources to target weights by Poisson replication.

A source with target weight w gets the mean repetition rate  w * (documents in all) / (documents of the source),
so the expected size of the mix is that of the corpus. Each document draws its number of copies by inverting the
Poisson distribution at a uniform number hashed from (seed, doc_id): the same in every run and at every
partitioning. Copies are then shuffled globally: a hash of (seed, doc_id, copy) gives each its partition and its
place in it.

Rates above ``PIECE`` are drawn as a sum of independent Poisson pieces, so no rate under- or overflows and no
copies are capped.

Nulls and edges: a null source is a source of its own; a null doc_id is hashed as the word null; a null text is
copied as it is, a very long one too; equal rows draw the same count, and copies that tie in the hash order lie in any order; a source missing from ``weights`` has ``default`` weight, a
weight of 0 drops it; extra columns are carried, but for one named ``copy``, which the number of the copy
replaces; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common as C

SEED = 1337
PIECE = 64.0
#: The largest number that _uniform gives.
LAST = 1.0 - 1.0 / (1 << 52)
#: Terms of the distribution of one piece; the rest of its mass is under 1e-17.
TERMS = 180


def _uniform(*parts):
    """A number in [0, 1) from the md5 of the parts: 52 bits, exact in a double."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, default: float = 1.0) -> DataFrame:
    """For each source: mean rate, number of pieces and the cumulative distribution of a piece."""
    counts = docs.groupBy(F.col("source").alias("_gr_source")).agg(F.count("*").alias("n"))
    w = F.lit(float(default))
    for k, v in (weights or {}).items():
        w = F.when(F.col("_gr_source") == k, F.lit(float(v))).otherwise(w)
    counts = counts.withColumn("w", w)
    total = counts.agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w"))
    rate = counts.crossJoin(total).withColumn("rate", F.col("w") / F.col("all_w") * F.col("all_n") / F.col("n"))
    rate = rate.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("int")).withColumn("mean", F.col("rate") / F.col("pieces"))
    ln_fact = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(TERMS)])
    pmf = F.transform(ln_fact, lambda f, k: F.exp(k * F.ln("mean") - F.col("mean") - f))
    cdf = F.aggregate(pmf, F.array().cast("array<double>"), lambda acc, p: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + p)))
    reached = F.filter(cdf, lambda c: c <= LAST)  # terms beyond the largest uniform number never count
    return rate.select("_gr_source", F.col("rate").alias("_gr_rate"), F.col("pieces").alias("_gr_pieces"), F.when(F.col("mean") > 0, reached).otherwise(F.array().cast("array<double>")).alias("_gr_cdf"), (F.col("mean") > 0).alias("_gr_some"))


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, default: float = 1.0, seed: int = SEED, shuffle: bool = True, copy: str = "copy") -> DataFrame:
    """docs with a column ``copy`` (0, 1, ...; or so named), each row as often as its draw says, in a global random order."""
    rates = C.cut(source_rates(docs, weights, default))
    key = [F.lit(str(seed)), F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))]
    uniform = F.transform(F.sequence(F.lit(1), rates["_gr_pieces"]), lambda p: _uniform(*key, p.cast("string")))
    draws = F.transform(uniform, lambda u: F.size(F.filter(rates["_gr_cdf"], lambda c: c <= u)))
    joined = docs.join(C.broadcast_if_small(rates, 8 * TERMS + 64), docs["source"].eqNullSafe(rates["_gr_source"]))
    count = F.when(rates["_gr_some"], F.aggregate(draws, F.lit(0), lambda a, b: a + b)).otherwise(0)
    kept = [docs[f"`{c}`"] for c in docs.columns if c.lower() != copy.lower()]
    n, place = C.fresh(docs, "_gr_n"), C.fresh(docs, "_gr_place")
    out = joined.select(*kept, count.alias(n)).filter(F.col(n) > 0)
    out = out.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(n) - 1))).drop(n)
    if not shuffle:
        return out
    out = out.withColumn(place, F.xxhash64(F.lit(seed), F.col("doc_id"), F.col(copy)))
    return out.repartition(F.col(place)).sortWithinPartitions(place).drop(place)


SQL = f"""
WITH counts AS (SELECT source AS src, count(*) AS n, 1.0::DOUBLE AS w FROM documents GROUP BY source),
rates AS (
  SELECT src, w / (SELECT sum(w) FROM counts) * (SELECT sum(n) FROM counts)::DOUBLE / n AS rate FROM counts
), cdfs AS (
  SELECT src, greatest(1, ceil(rate / {PIECE}))::INT AS pieces, rate / greatest(1, ceil(rate / {PIECE})) AS mean FROM rates
), terms AS (
  SELECT src, pieces, k, sum(exp(k * ln(mean) - mean - lgamma((k + 1)::DOUBLE))) OVER (PARTITION BY src ORDER BY k) AS c
  FROM cdfs, range({TERMS}) AS r(k)
), cdf AS (SELECT src, any_value(pieces) AS pieces, list(c ORDER BY k) AS cdf FROM terms GROUP BY src),
pieces AS (
  SELECT d.*, cdf, unnest(range(1, pieces + 1)) AS p FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.src
), drawn AS (
  SELECT doc_id, text, lang, source, n_chars, p,
         len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null') || '|' || p), 1, 13))::BIGINT / 4503599627370496.0)) AS n
  FROM pieces
), total AS (SELECT doc_id, text, lang, source, n_chars, sum(n)::BIGINT AS n FROM drawn GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, unnest(range(0, n))::INT AS copy FROM total WHERE n > 0
"""
