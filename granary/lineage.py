"""Cutting lineage in the folder that all executors share, so a lost executor costs no more than its own tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only where that is unset on a single machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not found and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(found or tempfile.mkdtemp(prefix="granary-checkpoint-"))
    return found or context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def made(path: str) -> str:
    """path, remembered for passing()."""
    _made.append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """As cut(), as a Parquet table: columns can be pruned by later readers."""
    spark = df.sparkSession
    path = made(f"{shared_folder(spark).rstrip('/')}/granary-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that were written to cut lineage inside it: for code that has written its own outcome by then."""
    before = len(_made)
    yield
    while len(_made) > before:
        remove(spark, _made.pop())
