"""Continuous ingest: new reports are segmented as they arrive, and findings are counted in windows of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from auditlake.operators.segment import segments

REPORT = "doc_id string, origin string, markdown string"


def report_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(REPORT).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def start_segmenting(stream: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write the segments of each batch of reports under its number; a batch that runs again replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        found = segments(batch, native=F.coalesce(F.col("origin") != "pdf", F.lit(True)))
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_counts(stream: DataFrame, at: str, key: str, window: str = "1 day", delay: str = "7 days") -> DataFrame:
    """(window_start, key, n): events by window of event time; those later than ``delay`` are left out."""
    timed = stream.withWatermark(at, delay)
    return timed.groupBy(F.window(at, window), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), key, "n")
