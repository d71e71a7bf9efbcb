"""Fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions.edits import time_id
from editpulse.functions.keys import article_key, editor_key, page_key
from editpulse.operators.numbering import latest_per_key, number_rows


def fact_edit(stg_edit: DataFrame, dedupe: str | None = None) -> DataFrame:
    """One row per edit. ``dedupe="latest"`` keeps the newest row of each edit_id of this load."""
    if dedupe == "latest":
        stg_edit = latest_per_key(stg_edit, ["edit_id"], ["ts", "ingested_at"])
    elif dedupe is not None:
        raise ValueError(f"dedupe must be None or 'latest', not {dedupe!r}")
    return stg_edit.select(
        "edit_id",
        time_id(F.col("minute_bucket")).alias("time_id"),
        "minute_bucket",
        F.col("wiki_db").alias("wiki_id"),
        page_key(F.col("wiki_db"), F.col("namespace"), F.col("page_title")).alias("page_id"),
        editor_key(F.col("editor"), F.col("editor_type")).alias("editor_id"),
        "ts",
        F.col("parent_id").alias("parent_edit_id"),
        "bytes_changed",
        "is_minor",
        "is_bot",
        "is_anon",
        "is_revert",
        "comment",
        "editor_type",
        "ip_class_v4",
        "namespace",
        "ingested_at",
    )


def fact_clickstream(spark: SparkSession, stg_clickstream: DataFrame, work_dir: str | None = None) -> DataFrame:
    """One row per navigation count, numbered by month, wiki, target and referer.

    Equal positions are ordered by navigation type and count. Names sort by bytes.
    """
    numbered = number_rows(
        spark,
        stg_clickstream.select(
            "dump_month", "wiki_db", "target", "referer", "nav_type", "nav_count", "referer_is_external"
        ),
        order_by=["dump_month", "wiki_db", "target", "referer", "nav_type", "nav_count"],
        number="fc_id",
        work_dir=work_dir,
    )
    wiki = F.col("wiki_db")
    return numbered.select(
        "fc_id",
        wiki.alias("wiki_id"),
        article_key(wiki, F.col("target")).alias("target_page_id"),
        F.when(F.col("referer_is_external"), None)
        .otherwise(article_key(wiki, F.col("referer")))
        .alias("referer_page_id"),
        "nav_type",
        "nav_count",
        "dump_month",
    )
