"""Balance gates and audits over decided rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.sampling import numbered


def over_represented(rows: DataFrame, group: str, order: list[str], share: float = 0.5) -> DataFrame:
    """rows with a flag ``surplus``: of each group beyond its allowed share the first ones in order.

    One pass: shares are of the rows before the gate. Nothing is surplus where there is one group only. Rows are
    written once and numbered within their groups by ranges of (group, order), so neither are they made twice nor is a
    group that holds most of them sorted by one task.
    """
    ranked = numbered(rows, [group, *order], "_gr_all")
    sizes = ranked.groupBy(group).agg(F.count("*").alias("_gr_n"), F.min("_gr_all").alias("_gr_first"))
    total = sizes.agg(F.sum("_gr_n").alias("_gr_rows"), F.count("*").alias("_gr_groups"))
    over = F.when(F.col("_gr_groups") > 1, F.col("_gr_n") - F.greatest(F.lit(1), F.floor(F.col("_gr_rows") * share))).otherwise(0)
    limits = sizes.crossJoin(total).select(F.col(group).alias("_gr_g"), (F.col("_gr_first") + over).alias("_gr_last"))  # total is one row
    out = ranked.join(limits, F.col(group).eqNullSafe(F.col("_gr_g")))
    return out.withColumn("surplus", F.col("_gr_all") < F.col("_gr_last")).drop("_gr_g", "_gr_last", "_gr_all")


def distributions(rows: DataFrame, fields: dict[str, str], missing: str = "<missing>") -> DataFrame:
    """(field, value, n) of all fields in one pass; a field given as array counts each of its elements."""
    kinds = dict(rows.dtypes)
    pair = lambda f, x: F.struct(F.lit(f).alias("field"), F.coalesce(x.cast("string"), F.lit(missing)).alias("value"))

    def of(f: str, c: str):
        return F.transform(c, lambda x: pair(f, x)) if kinds[c].startswith("array") else F.array(pair(f, F.col(c)))

    values = [of(f, c) for f, c in fields.items()]
    return rows.select(F.explode(F.concat(*values)).alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


def against_targets(counts: DataFrame, targets: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """(name, n, actual, target, delta, within) for the names of counts (name, n) and targets (name, target) together."""
    total = counts.agg(F.sum("n").alias("total"))
    both = counts.join(targets, "name", "full").crossJoin(F.broadcast(total))
    n, target = F.coalesce("n", F.lit(0)), F.coalesce("target", F.lit(0.0))
    actual = F.when(F.coalesce("total", F.lit(0)) > 0, n / F.col("total")).otherwise(0.0)
    return both.select("name", n.alias("n"), F.round(actual, 4).alias("actual"), F.round(target, 4).alias("target"), F.round(actual - target, 4).alias("delta"), (F.abs(actual - target) <= tolerance).alias("within"))


def coverage(refs: DataFrame, configured: DataFrame) -> DataFrame:
    """For each domain of configured (domain, ref): how many refs are configured and covered, the missing ones, and all uses."""
    counts = refs.groupBy("ref").agg(F.count("*").alias("n"))
    both = configured.join(counts, "ref", "left")
    has = F.col("n").isNotNull()
    return both.groupBy("domain").agg(F.count("*").alias("configured"), F.count_if(has).alias("covered"), F.array_join(F.array_sort(F.collect_list(F.when(~has, F.col("ref")))), ",").alias("missing"), F.coalesce(F.sum("n"), F.lit(0)).alias("uses"))
