"""The row rules on a stream: candidates are decided as they arrive, each batch joined to the static documents.

Rules look at one row and its document, so no state is kept; duplicates within the watermark are dropped by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators import rules


def decided(stream: DataFrame, docs: DataFrame, policy: dict, key: str | None = None, time: str | None = None, late: str = "10 minutes") -> DataFrame:
    """A stream of candidates with their issues, status and scores; docs has the doc_* columns and source_doc_id."""
    if key and time:
        stream = stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    return rules.decided(stream.join(docs, "source_doc_id", "left"), policy)


def status_counts(decisions: DataFrame, time: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by window and status, final once the watermark has passed the window."""
    return decisions.withWatermark(time, late).groupBy(F.window(time, window), "quality_status").agg(F.count("*").alias("n"))


def written(stream: DataFrame, path: str, checkpoint: str):
    """Start writing the stream as Parquet by status, all that is there now."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("quality_status").trigger(availableNow=True).start(path)
