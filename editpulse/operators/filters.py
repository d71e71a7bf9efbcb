"""Predicates of the trailing-window queries, always as Columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDITOR_CLASSES = ("any", "humans", "anonymous", "bots")

AsOf = dt.datetime | str | Column | None


def instant(as_of: AsOf) -> Column:
    """The "now" of a query; None is the real one."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def back(as_of: AsOf, *, days: int = 0, hours: int = 0, minutes: int = 0) -> Column:
    return instant(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes))


def date_floor(rows: DataFrame, time_col: str, bound: Column) -> DataFrame:
    """Rows of the partitions that can hold times from ``bound`` on; all rows if not laid out by that time."""
    partition = {
        "ingested_at": "ingest_date", "ts": "edit_date", "minute_bucket": "mart_date", "window_start": "mart_date"
    }.get(time_col)
    return rows.where(F.col(partition) >= F.to_date(bound)) if partition in rows.columns else rows


def scope_filter(wiki: str | None = None, namespace: int | None = None) -> Column:
    condition = F.lit(True)
    if wiki is not None:
        condition = condition & (F.col("wiki_db") == wiki)
    if namespace is not None:
        condition = condition & (F.col("namespace") == namespace)
    return condition


def editor_filter(editor_class: str = "any") -> Column:
    if editor_class not in EDITOR_CLASSES:
        raise ValueError(f"editor_class must be one of {EDITOR_CLASSES}, not {editor_class!r}")
    return {
        "any": F.lit(True),
        "humans": ~F.col("is_bot"),
        "anonymous": F.col("is_anon"),
        "bots": F.col("is_bot"),
    }[editor_class]


def live_filter(
    as_of: AsOf = None,
    window_min: int = 15,
    wiki: str | None = None,
    namespace: int | None = None,
    editor_class: str = "any",
    time_col: str = "ingested_at",
) -> Column:
    recent = F.col(time_col) > back(as_of, minutes=window_min)
    return recent & scope_filter(wiki, namespace) & editor_filter(editor_class)


def previous_filter(
    as_of: AsOf = None,
    window_min: int = 15,
    wiki: str | None = None,
    namespace: int | None = None,
    time_col: str = "ingested_at",
) -> Column:
    """The equal-length window before; the editor class plays no part in it."""
    when = F.col(time_col)
    before = (when > back(as_of, minutes=2 * window_min)) & (when <= back(as_of, minutes=window_min))
    return before & scope_filter(wiki, namespace)
