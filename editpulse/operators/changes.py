"""Which dates of a table changed, for tables that are built from it: a small log kept beside it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from editpulse.sources.lookups import set_table_property, table_exists, table_property

# Table property of a derived table: the last change of its source that it holds.
_SEEN = "editpulse.seen_change"


def changes_table(table: str) -> str:
    return f"{table}_changes"


def last_change(spark: SparkSession, table: str) -> int:
    """The number of the newest change; 0 if nothing was ever logged."""
    if not table_exists(spark, changes_table(table)):
        return 0
    return spark.table(changes_table(table)).agg(F.coalesce(F.max("change_no"), F.lit(0))).first()[0]


def log_changes(spark: SparkSession, table: str, dates: Iterable[dt.date | None]) -> None:
    """Append one change with its dates, before they are replaced: a date may be named in vain, never missed."""
    number = last_change(spark, table) + 1
    rows = spark.createDataFrame([(number, date) for date in dates], "change_no BIGINT, changed DATE").coalesce(1)
    if table_exists(spark, changes_table(table)):
        rows.write.insertInto(changes_table(table))
    else:
        rows.write.format("parquet").saveAsTable(changes_table(table))


def seen_change(spark: SparkSession, derived: str) -> int | None:
    """The last change that a derived table holds; None for a table that was never marked."""
    kept = table_property(spark, derived, _SEEN)
    return None if kept is None else int(kept)


def mark_seen(spark: SparkSession, derived: str, number: int) -> None:
    set_table_property(spark, derived, _SEEN, str(number))


def changed_dates(spark: SparkSession, table: str, since: int, until: int) -> set:
    """The dates of the changes after ``since`` up to ``until``: no more than the table has partitions."""
    if not table_exists(spark, changes_table(table)):
        return set()
    rows = spark.table(changes_table(table)).where(F.col("change_no").between(since + 1, until))
    return {r[0] for r in rows.select("changed").distinct().collect()}
