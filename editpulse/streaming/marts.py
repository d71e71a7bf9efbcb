"""Live marts of closed windows. Late rows beyond the watermark are left out here; ``live`` corrects minutes by them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.functions.keys import page_key
from editpulse.functions.labels import ratio
from editpulse.operators.staging import stg_edit
from editpulse.plans.marts import burst_counts, is_candidate, rank_minutes

WATERMARK = "10 minutes"
_PAGE = ("wiki_id", "page_id", "page_title")


def watermarked_articles(raw_edits: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Article edits with their page key, from a stream of landing rows."""
    edits = stg_edit(raw_edits.withWatermark("ts", delay)).where(F.col("namespace") == 0)
    return edits.select(
        "ts",
        F.col("wiki_db").alias("wiki_id"),
        page_key(F.col("wiki_db"), F.col("namespace"), F.col("page_title")).alias("page_id"),
        "page_title",
        "is_bot",
        "is_anon",
        "is_revert",
        F.when(F.col("is_anon"), F.col("ip_class_v4")).alias("ip_class_v4"),
    )


def minute_counts(raw_edits: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Edits per page and minute, without bots; a minute appears once, when it is closed."""
    people = watermarked_articles(raw_edits, delay).where(~F.col("is_bot"))
    counts = people.groupBy(F.window("ts", "1 minute"), *_PAGE).agg(F.count(F.lit(1)).alias("edit_count"))
    return counts.select(F.col("window.start").alias("minute_bucket"), *_PAGE, "edit_count")


def rank_closed_minutes(batch: DataFrame) -> DataFrame:
    """Ranks of one micro-batch of :func:`minute_counts`; exact, since a minute is never split."""
    return rank_minutes(batch)


def vandalism_windows(raw_edits: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Closed 10-minute windows (every 5 minutes) that look like vandalism.

    Distinct networks are counted by two chained aggregations, first per network and then per
    window, so the state of one page never holds a set of networks in one row.
    """
    edits = watermarked_articles(raw_edits, delay)
    per_network = edits.groupBy(F.window("ts", "10 minutes", "5 minutes"), *_PAGE, "ip_class_v4").agg(*burst_counts())
    totals = {name: F.sum(name).alias(name) for name in ("anon_edit_count", "total_edit_count", "_reverts")}
    windows = per_network.groupBy("window", *_PAGE).agg(
        *totals.values(), F.count("ip_class_v4").alias("distinct_ip_classes")
    )
    scored = windows.withColumn("revert_share", ratio(F.col("_reverts"), F.col("total_edit_count")))
    return scored.where(is_candidate()).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *_PAGE,
        "anon_edit_count",
        "total_edit_count",
        "distinct_ip_classes",
        "revert_share",
    )
