"""Every registered query that has SQL, compared with DuckDB on the smallest tables; the others are run."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from granary.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, duck, same, name):
    same(entry.queries()[name](spark, sf), duck(SQL[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() >= 0


def test_imports_without_a_session():
    root = os.path.dirname(entry.__file__)
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], cwd=root, check=True)


def test_entry(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"source", "quality_status", "n", "mean_score"} and df.count() > 0


def test_every_rule_branch_occurs(spark, sf):
    row = entry.queries()["val_00_row_decision"](spark, sf)
    sums = row.groupBy().sum().first().asDict()
    assert all(v > 0 for k, v in sums.items() if k.startswith("sum(n_") or k in ("sum(links)", "sum(too_long)"))
    assert {r.quality_status for r in row.select("quality_status").distinct().collect()} == {"filtered", "review", "rejected"}
