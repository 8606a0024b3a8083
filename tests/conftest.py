import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf):
    """Runs DuckDB SQL over the smallest tables: column names and rows."""
    import duckdb

    con = duckdb.connect()
    for t in sorted(os.listdir(sf)):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{sf}/{t}'")

    def run(sql, **tables):
        for name, frame in tables.items():
            con.register(name, frame)
        try:
            rel = con.sql(sql)
            return rel.columns, rel.fetchall()
        finally:
            for name in tables:
                con.unregister(name)

    return run


def normal(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([normal(x) for x in v])
    try:
        return f"{float(v):.9g}" if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


@pytest.fixture(scope="session")
def same():
    """Asserts that a DataFrame and the outcome of duck() have the same columns and rows."""

    def check(df, outcome):
        columns, rows = outcome
        names = sorted(df.columns)
        assert names == sorted(columns)
        order = [columns.index(c) for c in names]
        got = sorted(tuple(map(normal, r)) for r in df.select(*[f"`{c}`" for c in names]).collect())
        want = sorted(tuple(normal(r[i]) for i in order) for r in rows)
        assert got == want

    return check
