"""Minute-grain time dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions.edits import time_id

# The range the time dimension covers unless told otherwise.
DEFAULT_START = dt.datetime(2026, 1, 1, 0, 0)
DEFAULT_END = dt.datetime(2026, 12, 31, 23, 59)


def _calendar_parts(minutes: DataFrame) -> DataFrame:
    ts = F.col("ts")
    weekday = F.dayofweek(ts) - 1
    return minutes.select(
        time_id(ts).alias("time_id"),
        ts,
        F.to_date(ts).alias("date"),
        F.hour(ts).cast("smallint").alias("hour"),
        F.minute(ts).cast("smallint").alias("minute"),
        weekday.cast("smallint").alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def build_dim_time(
    spark: SparkSession, start: dt.datetime = DEFAULT_START, end: dt.datetime = DEFAULT_END
) -> DataFrame:
    """One row per minute of [start, end] (UTC). Sunday is day 0."""
    epoch = dt.datetime(1970, 1, 1)
    first, last = ((t - epoch) // dt.timedelta(minutes=1) for t in (start, end))
    minutes = spark.range(first, last + 1)
    return _calendar_parts(minutes.select(F.timestamp_seconds(F.col("id") * 60).alias("ts")))


def dim_time_covering(edits: DataFrame, ts: str = "ts") -> DataFrame:
    """The time dimension for all whole days that hold an edit, so foreign keys hold in any year."""
    days = edits.where(F.col(ts).isNotNull()).select(F.to_date(ts).cast("timestamp").alias("day")).distinct()
    minute = F.explode(F.expr("sequence(day, day + interval 1439 minutes, interval 1 minute)"))
    return _calendar_parts(days.select(minute.alias("ts")))
