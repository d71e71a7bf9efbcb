"""Landing rows to cleaned, enriched staging rows (views: nothing is stored)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.functions import edits as fe

# Referers that are not pages.
SYNTHETIC_REFERERS = ("other-search", "other-external", "other-internal", "other-empty", "other-other")


def stg_edit(raw_edits: DataFrame) -> DataFrame:
    is_bot, is_anon, editor = F.col("is_bot"), F.col("is_anon"), F.col("editor")
    keyed = F.col("edit_id").isNotNull() & F.col("wiki_db").isNotNull() & F.col("page_title").isNotNull()
    return raw_edits.where(keyed).withColumns(
        {
            "minute_bucket": fe.minute_of(F.col("ts")),
            "editor_type": fe.editor_type(is_bot, is_anon),
            "ip_class_v4": fe.ip_class_v4(editor, is_anon),
            "is_revert": fe.is_revert(F.col("comment")),
        }
    )


def stg_clickstream(raw_clickstream: DataFrame) -> DataFrame:
    rows = raw_clickstream.where((F.col("nav_count") > 0) & F.col("target").isNotNull())
    return rows.withColumn("referer_is_external", F.col("referer").isin(*SYNTHETIC_REFERERS))
