"""Incremental refresh of the long event table with Structured Streaming.

The reference rebuilds its materialised tables by hand.  Here new event
files are picked up as they land: each micro-batch is harmonised (stateless)
and appended to the parquet long table.  The query's checkpoint and the table
live under the shared ``spark.checkpoint.dir``, so a restarted or failed job
resumes exactly where it stopped.  Stay times are attached when the table is
read, against the stays known then: an event that lands before its stay is
not lost, and a stay whose span moves leaves no stale windows behind.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from wardflow.plans.features import windowed_features
from wardflow.session import checkpoint_dir
from wardflow.sources import analogues as an
from wardflow.sources import dictionary as dic


def events_stream(spark: SparkSession, events_path: str, schema) -> DataFrame:
    """A file stream of the event log (new parquet files are new events)."""
    return spark.readStream.schema(schema).parquet(events_path)


def start_refresh(stream: DataFrame, name: str, available_now: bool = True,
                  processing_time: str | None = None):
    """Append ``stream`` to the parquet table ``name`` under the checkpoint
    folder; returns the StreamingQuery.  ``available_now`` processes what
    has landed and stops (a scheduled refresh); otherwise it keeps running."""
    spark = stream.sparkSession
    base = os.path.join(checkpoint_dir(spark), "streams", name)
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", os.path.join(base, "table"))
         .option("checkpointLocation", os.path.join(base, "checkpoint")))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(checkpoint_dir(spark), "streams", name, "table"))


def refresh_events(spark: SparkSession, events_path: str, name: str = "events_long"):
    """The events analogue: stream ``events`` into the long table."""
    schema = spark.read.parquet(events_path).schema
    return start_refresh(an.events_long(spark, events_stream(spark, events_path, schema)), name)


def windowed_table(spark: SparkSession, name: str, stays: DataFrame,
                   tolerance_seconds: float = dic.STAY_TOLERANCE_SECONDS) -> DataFrame:
    """The windowed rows of everything that has landed, with today's stays."""
    return windowed_features(table(spark, name), stays, tolerance_seconds)
