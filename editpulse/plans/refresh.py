"""Tables kept up to date by recomputing what a load changed, instead of being rebuilt as a whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editpulse.operators import changes
from editpulse.operators.facts import fact_clickstream
from editpulse.operators.filters import AsOf, back
from editpulse.operators.upsert import drop_dates, overwrite_partitions
from editpulse.plans import marts
from editpulse.plans.descriptions import described
from editpulse.session import new_work_dir
from editpulse.sinks.tables import arrange, layout_for, materialize_table
from editpulse.sources.lookups import set_table_property, table_exists, table_property

_DAY = dt.timedelta(days=1)


@dataclass(frozen=True)
class Reach:
    """How far a changed date of edits reaches in a mart."""

    # Days of edits before a date that the mart's rows of that date look at.
    looks_back: int = 0
    # Days before and after a changed date whose rows change with it; None: all later ones.
    before: int = 0
    after: int | None = 0
    # Only the trailing days of edits are in the mart.
    keeps_days: int | None = None
    # The mart's own earlier rows stand for the edits before the recomputed dates.
    continues: bool = False


REACH: dict[str, Reach] = {
    "marts.trending_per_minute": Reach(),
    # The 60th row back of a page may lie any number of days back, so later dates change as well.
    "marts.edit_velocity": Reach(after=None, continues=True),
    # A page's change against exactly an hour ago: the first hour of the next day looks into this one.
    "marts.edit_velocity_60min": Reach(looks_back=1, after=1),
    "marts.vandalism_candidates": Reach(keeps_days=7),
    # The window that begins five minutes before midnight holds edits of two days, and lies in the first.
    "marts.vandalism_sliding": Reach(looks_back=1, before=1, keeps_days=7),
}


def affected_dates(changed: set[dt.date], known: set[dt.date], reach: Reach) -> set[dt.date]:
    """The mart's dates to recompute; ``known`` are those of the edits now or of the mart."""
    if not changed:
        return set()
    if reach.after is None:
        return {d for d in known | changed if d >= min(changed) - reach.before * _DAY}
    return {d + n * _DAY for d in changed for n in range(-reach.before, reach.after + 1)}


def _dates(rows: DataFrame, column: str) -> set:
    """Values of a partition column."""
    return {r[0] for r in rows.select(column).distinct().collect()}


def _stored_dates(spark: SparkSession, table: str) -> set[dt.date]:
    """The dates a table has partitions for, from the catalog alone; not the undated one."""
    values = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return {dt.date.fromisoformat(v) for v in values if not v.startswith("__")}


def _derive(name: str, fact: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame, as_of: AsOf, earlier: DataFrame | None) -> DataFrame:
    recipes: dict[str, Callable[[], DataFrame]] = {
        "marts.trending_per_minute": lambda: marts.trending_per_minute(fact, dim_wiki, dim_page),
        "marts.edit_velocity": lambda: marts.velocity_asis(fact, dim_wiki, dim_page, earlier),
        "marts.edit_velocity_60min": lambda: marts.velocity_60min(fact, dim_wiki, dim_page),
        "marts.vandalism_candidates": lambda: marts.vandalism_asis(fact, dim_wiki, dim_page, as_of),
        "marts.vandalism_sliding": lambda: marts.vandalism_sliding(fact, dim_wiki, dim_page, as_of),
    }
    return recipes[name]()


def _history(mart: DataFrame, fact: DataFrame, first: dt.date) -> DataFrame:
    """The mart's last 60 rows before ``first`` of each page that was edited since, as counts of edits."""
    pages = fact.select("page_id").distinct()
    newest = Window.partitionBy("page_id").orderBy(F.desc("minute_bucket"))
    before = mart.where((F.col("mart_date") < F.lit(first)) | F.col("mart_date").isNull()).join(pages, "page_id", "left_semi")
    counts = before.select("minute_bucket", "wiki_id", "page_id", F.col("edits_this_min").alias("edit_count"))
    return counts.withColumn("_nth", F.row_number().over(newest)).where("_nth <= 60").drop("_nth")


def refresh_mart(
    spark: SparkSession, mart: str, name: str, fact_table: str, dim_wiki: DataFrame, dim_page: DataFrame, as_of: AsOf = None, whole: bool = False
) -> set | None:
    """Bring a stored mart up to the changes of the edit fact; ``name`` is the relation it holds.

    Gives the recomputed dates; None if it was built as a whole: at first, with ``whole``, and when undated edits changed.
    The new rows are staged and swapped in by date; the number of the last change is kept with the mart once
    that is done, so a refresh that dies is done again by the next.
    """
    reach, fact, layout = REACH[name], spark.table(fact_table), layout_for(name)
    until = changes.last_change(spark, fact_table)
    seen = changes.seen_change(spark, mart) if table_exists(spark, mart) else None
    changed = changes.changed_dates(spark, fact_table, seen, until) if seen is not None else {None}
    if whole or None in changed:
        materialize_table(_derive(name, fact, dim_wiki, dim_page, as_of, None), mart, layout, described)
        changes.mark_seen(spark, mart, until)
        return None
    stored = spark.table(mart)
    known = _stored_dates(spark, mart)
    dates = affected_dates(changed, known | _stored_dates(spark, fact_table), reach)
    if reach.keeps_days is not None:
        # Dates before the trailing days go, and the first of them is only partly there.
        first = spark.range(1).select(F.to_date(back(as_of, days=reach.keeps_days))).first()[0]
        dates = {d for d in dates if d >= first} | {d for d in known if d < first} | {first - n * _DAY for n in range(reach.before + 1)}
    if dates:
        needed = {d + n * _DAY for d in dates for n in range(-reach.looks_back, reach.before + 1)}
        part = fact.where(F.col("edit_date") >= F.lit(min(dates)) if reach.after is None else F.col("edit_date").isin(*needed))
        earlier = _history(stored, part, min(dates)) if reach.continues else None
        fresh = arrange(_derive(name, part, dim_wiki, dim_page, as_of, earlier), layout)
        stage = new_work_dir(spark, "refresh")
        fresh.where(F.col("mart_date").isin(*dates)).write.parquet(stage)
        staged = spark.read.schema(fresh.schema).parquet(stage)
        drop_dates(spark, mart, "mart_date", (dates & known) - _dates(staged, "mart_date"))
        overwrite_partitions(spark, mart, arrange(staged, layout))
    changes.mark_seen(spark, mart, until)
    return dates


# Table property of the numbered navigation fact: the newest landing time it holds, in microseconds.
_NUMBERED_UNTIL = "editpulse.numbered_until"


def _month_filter(rows: DataFrame, months: set, column: str = "dump_month") -> DataFrame:
    real = [m for m in months if m is not None]
    chosen = F.col(column).isin(*real) if real else F.lit(False)
    return rows.where(chosen | F.col(column).isNull() if None in months else chosen)


def refresh_clickstream(spark: SparkSession, table: str, landed: DataFrame, stage_rows: Callable[[DataFrame], DataFrame], whole: bool = False) -> set | None:
    """Bring the numbered navigation fact up to newly landed months.

    Numbers follow the month first, so those of a month are its rows' places after all rows of earlier months. Only months
    with rows that landed since the last time are sorted and numbered; months behind one that changed its size are moved
    by the difference, without a sort; other months are not touched. Gives the months written; None for a whole build.
    ``stage_rows`` turns landed rows into staged ones.
    """
    newest = landed.agg(F.unix_micros(F.max("ingested_at"))).first()[0]
    mark = table_property(spark, table, _NUMBERED_UNTIL) if table_exists(spark, table) else None
    layout = layout_for("core.fact_clickstream")
    if whole or mark is None or newest is None:
        materialize_table(fact_clickstream(spark, stage_rows(landed)), table, layout, described)
        set_table_property(spark, table, _NUMBERED_UNTIL, str(newest or 0))
        return None
    since, until = (F.timestamp_micros(F.lit(m).cast("bigint")) for m in (int(mark), newest))
    changed = _dates(landed.where((F.col("ingested_at") > since) & (F.col("ingested_at") <= until)), "dump_month")
    if not changed:
        return set()
    stored = spark.table(table)
    # One row a month: bounded by the calendar.
    old = {r[0]: r[1] for r in stored.groupBy("dump_month").count().collect()}
    fresh = fact_clickstream(spark, stage_rows(_month_filter(landed, changed)))
    path = new_work_dir(spark, "months")
    fresh.write.parquet(path)
    numbered = spark.read.schema(fresh.schema).parquet(path)
    sizes = {r[0]: r[1] for r in numbered.groupBy("dump_month").count().collect()}
    shifts: list[tuple] = []
    old_start = new_start = fresh_start = 0
    for month in sorted(old.keys() | changed, key=lambda m: (m is not None, m or dt.date.min)):
        size = sizes.get(month, 0) if month in changed else old[month]
        shifts.append((month, month in changed, new_start - (fresh_start if month in changed else old_start)))
        old_start, new_start = old_start + old.get(month, 0), new_start + size
        fresh_start += size if month in changed else 0
    moved = {m for m, is_new, by in shifts if not is_new and by}
    by_month = spark.createDataFrame(shifts, "month DATE, is_new BOOLEAN, shift BIGINT")
    rows = numbered.withColumn("_new", F.lit(True)).unionByName(_month_filter(stored, moved).withColumn("_new", F.lit(False)))
    placed = rows.join(by_month, F.col("dump_month").eqNullSafe(F.col("month")) & (F.col("_new") == F.col("is_new")))
    placed = placed.withColumn("fc_id", F.col("fc_id") + F.col("shift")).select(*stored.columns)
    stage = new_work_dir(spark, "renumbered")
    placed.write.parquet(stage)
    staged = spark.read.schema(placed.schema).parquet(stage)
    keys = ("wiki_id", "dump_month")
    gone = _month_filter(stored, changed).select(*keys).distinct().exceptAll(staged.select(*keys).distinct()).collect()
    for wiki, month in gone:
        where = [f"{n} = {'NULL' if v is None else kind + repr(str(v))}" for n, v, kind in (("wiki_id", wiki, ""), ("dump_month", month, "DATE "))]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({', '.join(where)})")
    overwrite_partitions(spark, table, arrange(staged.repartitionByRange(*keys, *map(F.expr, layout.sort_by)), layout))
    set_table_property(spark, table, _NUMBERED_UNTIL, str(newest))
    return changed | moved
