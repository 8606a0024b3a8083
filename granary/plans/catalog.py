"""All queries of the corpus operators by name, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.plans import base, compact, files, gate, relational, scalars  # noqa: F401  (they register their queries)

FLAGSHIP = "agg_01_status_counts"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
