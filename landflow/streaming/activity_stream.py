"""Incremental activity loads with Structured Streaming.

Landed activity pages arrive as files under ``landing/day=<yyyy-MM-dd>/``.
A file stream notices new files; each micro-batch reloads every day it
touched from *all* landed pages of that day (a day's chain may arrive over
several batches, and a partial chain must never replace a stored day). The
reload goes through the same batch plan as ``load_activity`` and replaces
only the touched ``LoadDate`` partitions, so a replayed batch (after a
failure) writes the same rows again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from landflow.plans.pipelines import activity_rows
from landflow.session import release, scratch_path
from landflow.sinks.tables import replace_partition
from landflow.sources.pages import PAGE_SCHEMA

LANDED_SCHEMA = StructType(PAGE_SCHEMA.fields + [StructField("day", StringType())])


def land_activity_pages(pages: DataFrame, landing_path: str) -> None:
    """Append pages under ``day=`` folders (the day is read from the request
    key ``activityevents/<day>``)."""
    day = F.regexp_extract("request_key", r"(\d{4}-\d{2}-\d{2})", 1)
    pages.withColumn("day", day).write.mode("append").partitionBy("day").json(landing_path)


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def reload_days(spark: SparkSession, landing_path: str, days: list[str], table: str, run_ts: str) -> int:
    """Reload the given days from all their landed pages. The days are literals
    on the partition column, so the scan lists no other day's folder. A day whose
    chain is not complete yet keeps its stored rows."""
    pages = spark.read.schema(LANDED_SCHEMA).json(landing_path).where(F.col("day").isin(days))
    return replace_partition(activity_rows(pages, run_ts), table, "LoadDate")


def stream_activity(spark: SparkSession, landing_path: str, table: str,
                    checkpoint_location: str | None = None, available_now: bool = True,
                    max_files: int = 1000,
                    run_ts: str | None = None) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what has landed and
    stops (a scheduled daily job); otherwise it keeps running."""
    source = spark.readStream.schema(LANDED_SCHEMA).option("maxFilesPerTrigger", max_files).json(landing_path)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # as many days as the batch has files, at most
        days = [r["day"] for r in batch.select("day").distinct().collect()]
        if not days:
            return
        try:
            reload_days(spark, landing_path, days, table, run_ts or _now())
        finally:
            release()  # small cached sides of this batch; nothing accumulates

    writer = (source.writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", checkpoint_location or scratch_path(spark, "activity-stream")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
