"""New transcripts through the pipeline as they arrive, and sessions over the processing log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def process_new(spark: SparkSession, source: str, schema: str, checkpoint: str, step: Callable[[DataFrame, int], None]):
    """Starts a query that hands each batch of new files to ``step`` once and ends when all are done."""
    new = spark.readStream.schema(schema).parquet(source)
    return new.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions per user; works on tables and, with its watermark, on streams."""
    timed = events.withWatermark(ts, late) if events.isStreaming else events
    made = timed.groupBy(user, F.session_window(ts, gap).alias("session")).agg(F.count("*").alias("n_events"), F.sum("value").alias("value"))
    return made.select(user, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n_events", "value")
