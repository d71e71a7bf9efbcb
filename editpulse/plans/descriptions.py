"""What relations and their columns hold, kept with the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.sinks.tables import persist_docs

TABLES = {
    "raw.stg_edit": "Edits as they landed from the stream, payload included; a redelivered edit may come twice.",
    "raw.stg_clickstream": "Navigation counts as they landed from the monthly dumps.",
    "core.dim_time": "One row per minute.",
    "core.dim_wiki": "One row per wiki that was edited or navigated.",
    "core.dim_page": "One row per page (wiki, namespace, title) of either source.",
    "core.dim_editor": "One row per editor name and editor type.",
    "core.fact_edit": "One row per edit, the newest delivery of it.",
    "core.fact_clickstream": "One row per navigation count, numbered by month, wiki, target and referer.",
    "marts.trending_per_minute": "Article pages ranked by edits without bots within each minute.",
    "marts.edit_velocity": "Edits of a page and minute against the page's 60th row back.",
    "marts.vandalism_candidates": "Windows of a page with many anonymous edits or a high share of reverts, of the last seven days.",
}

# A column name means the same wherever it stands.
COLUMNS = {
    "edit_id": "Number of the edit on its wiki", "rev_id": "Revision that the edit made", "parent_id": "Revision before the edit",
    "parent_edit_id": "Revision before the edit", "ts": "Time of the edit, or the minute's begin", "ingested_at": "Time of landing",
    "page_title": "Title as it came, not normalised", "namespace": "Number of the page's namespace; 0 are articles", "wiki_db": "Database name of the wiki",
    "wiki_id": "Key of the wiki: its database name", "page_id": "Key of the page: hash of wiki, namespace and title",
    "editor": "Name or address of the editor", "editor_name": "Name or address of the editor", "editor_id": "Key of the editor: hash of name and type",
    "editor_type": "user, anon or bot", "is_anon": "The editor is an address", "is_bot": "The edit is flagged as a bot's", "is_minor": "The edit is flagged as minor",
    "is_revert": "The comment names a revert", "bytes_changed": "Length after minus length before", "comment": "Comment of the edit", "raw_payload": "The message as it came",
    "ip_class_v4": "The /24 network of an IPv4 editor", "edit_date": "UTC date of the edit", "ingest_date": "UTC date of landing", "time_id": "The minute as yyyyMMddHHmm",
    "minute_bucket": "The minute of the edits", "referer": "Page or kind of source before", "target": "Page that was opened", "nav_type": "link, external or other",
    "nav_count": "Navigations of the month", "dump_month": "First day of the dump's month", "date": "UTC date", "hour": "Hour of the day", "minute": "Minute of the hour",
    "day_of_week": "0 is Sunday", "is_weekend": "Saturday or Sunday", "language": "Language code of the wiki", "family": "Project family of the wiki",
    "created_at": "Time of the build that made the row", "first_seen": "Time of the build that made the row", "fc_id": "Running number of the count",
    "target_page_id": "Key of the opened page", "referer_page_id": "Key of the page before; none for other sources", "edit_count": "Edits of the page in the minute",
    "rank_in_minute": "Rank over all wikis, with gaps", "rank_in_wiki_minute": "Rank within the wiki, without gaps", "edits_this_min": "Edits of the page in the minute",
    "edits_lag_60": "Edits of the page's 60th row back", "accel": "Edits now minus those edits", "window_start": "Begin of the window", "window_end": "End of the window",
    "anon_edit_count": "Edits by addresses", "total_edit_count": "All edits", "distinct_ip_classes": "Different /24 networks", "revert_share": "Share of reverts",
    "mart_date": "UTC date of the minute or window",
}


def described(rows: DataFrame) -> DataFrame:
    """The rows with column descriptions, which a catalog table stores with its columns."""
    return rows.select(*[F.col(f"`{c}`").alias(c, metadata={"comment": COLUMNS[c]}) if c in COLUMNS else F.col(f"`{c}`") for c in rows.columns])


def describe_table(spark: SparkSession, relation: str, table: str) -> None:
    persist_docs(spark, table, TABLES.get(relation))
