"""Job events: the log after a sequence number, as a batch or as a stream over the log's folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "job_id string, sequence long, event string, at timestamp, payload string"
TERMINAL = ("cancelled", "failed", "completed", "interrupted")


def events_after(events: DataFrame, sequence: int) -> DataFrame:
    return events.where(F.col("sequence") > sequence).orderBy("sequence")


def watch(spark: SparkSession, folder: str, after: int = 0, late: str = "10 minutes") -> DataFrame:
    """A stream of new events; an event that is written twice is told once."""
    events = spark.readStream.schema(EVENT_SCHEMA).json(folder)
    return events.withWatermark("at", late).dropDuplicatesWithinWatermark(["job_id", "sequence"]).where(F.col("sequence") > after)
