"""Incremental maintenance of stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.operators import changes, key_index
from editpulse.session import new_work_dir
from editpulse.sources.lookups import set_table_property, table_property


def newer_than(source: DataFrame, target: DataFrame, column: str = "ingested_at") -> DataFrame:
    """Source rows strictly above the target's highest ``column`` (all rows for an empty target)."""
    high = target.agg(F.coalesce(F.max(column), F.timestamp_seconds(F.lit(0))).alias("high"))
    return source.where(F.col(column) > high.scalar())


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def replace_by_key(target: DataFrame, source: DataFrame, key: str | Sequence[str] = "edit_id") -> DataFrame:
    """Target without the source's keys, plus the source; columns new in the source start as NULL."""
    keys = source.select(*_names(key)).distinct()
    return target.join(keys, _names(key), "left_anti").unionByName(source, allowMissingColumns=True)


def add_missing(target: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Seed rows whose key the target does not have yet."""
    return seed.join(target.select(key).distinct(), key, "left_anti")


def in_order(rows: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], split: bool = True) -> DataFrame:
    """Rows sorted by the partition columns and ``sort_by`` (columns or SQL expressions), with ``split`` range-split by them before.

    Expressions are worked out once for each row: as part of a sort order they would be for both rows of every comparison.
    """
    names = [by if by in rows.columns else f"_order_{k}" for k, by in enumerate(sort_by)]
    made = {name: F.expr(by) for name, by in zip(names, sort_by) if name != by}
    order, rows = [*partition_by, *names], rows.withColumns(made)
    if split:
        rows = rows.repartitionByRange(*order)
    return rows.sortWithinPartitions(*order).drop(*made)


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def overwrite_partitions(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Replace exactly the partitions that ``rows`` has rows for."""
    with _dynamic_overwrite(spark):
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)


def drop_dates(spark: SparkSession, table: str, partition: str, dates: set) -> None:
    for date in dates:
        value = "NULL" if date is None else f"DATE '{date}'"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = {value})")


def add_new_columns(spark: SparkSession, table: str, rows: DataFrame) -> list[str]:
    """Append the columns ``rows`` has and the table lacks; stored rows read them as NULL."""
    known = {c.lower() for c in spark.table(table).columns}
    new = [f for f in rows.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def incremental_upsert(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    key: str | Sequence[str] = "edit_id",
    partition: str = "edit_date",
    work_dir: str | None = None,
    sort_by: Sequence[str] = (),
    indexed: bool = False,
    logged: bool = False,
    staged: bool = False,
) -> set:
    """Upsert ``source`` into a date-partitioned table, rewriting only the dates it touches.

    Touched dates are those of the new rows and those where a stored row has one of the new keys.
    Their new content is staged in the shared folder and then swapped in by a dynamic partition
    overwrite, split and sorted by ``sort_by``, so the table is never read while it is replaced.
    Running the same load twice leaves the same table.

    ``edit_id`` alone also replaces an edit of another wiki that has the same number; a composite key such as
    ``("wiki_id", "edit_id")`` does not. Finding the touched dates reads the key of every stored row, unless
    ``partition`` is part of the key: then only the dates of the new rows are read. With ``indexed`` a key index beside the
    table finds them (built by the first load): only its buckets with keys of the load are read, and rows only of touched dates.
    ``staged`` says that ``source`` only reads files that stay as they are, so it is not written again.
    With ``logged`` the dates go to the table's change log, for tables that are built from it.

    Gives the touched dates.
    """
    add_new_columns(spark, table, source)
    stage = work_dir or new_work_dir(spark, "upsert")
    if staged:
        new = source
    else:
        source.write.parquet(f"{stage}/new")
        new = spark.read.parquet(f"{stage}/new")
    target = spark.table(table)
    names = _names(key)
    touched = {r[0] for r in new.select(partition).distinct().collect()}
    if partition not in names and indexed:
        if key_index.buckets_of(spark, table, names) is None:
            key_index.build_index(spark, table, names, partition)
        buckets = key_index.buckets_of(spark, table, names)
        touched |= key_index.dates_of(spark, table, key_index.hashed(new, names, buckets))
        key_index.add_keys(spark, table, new, names, buckets, partition)
    elif partition not in names:
        # The table's dates are its partitions, so this list is as short as the partition list.
        replaced = spark.table(table).join(new.select(*names).distinct(), names, "left_semi")
        touched |= {r[0] for r in replaced.select(partition).distinct().collect()}
    if not touched:
        return touched
    if logged:
        changes.log_changes(spark, table, touched)
    in_touched = F.coalesce(F.col(partition).isin(*touched), F.lit(None in touched))
    merged = replace_by_key(spark.table(table).where(in_touched), new, key)
    merged.write.partitionBy(partition).parquet(f"{stage}/merged")
    rows = spark.read.schema(merged.schema).parquet(f"{stage}/merged")
    remaining = {r[0] for r in rows.select(partition).distinct().collect()}
    # Dates that end up empty go first: they hold replaced rows only, so a load that dies here leaves no row
    # twice and finds the same new rows when it runs again.
    drop_dates(spark, table, partition, touched - remaining)
    if sort_by:
        rows = in_order(rows, [partition], sort_by)
    overwrite_partitions(spark, table, rows)
    if partition not in names and indexed and key_index.loads(spark, table) > key_index.LOADS_KEPT:
        key_index.compact(spark, table, names, buckets)
    return touched


# Table property with the high-water mark of the last finished load, in microseconds.
_LOADED_UNTIL = "editpulse.loaded_until"


def loaded_until(spark: SparkSession, table: str, column: str = "ingested_at") -> int:
    """The table's high-water mark in microseconds: kept by the last load, else read from the rows (0 if there are none)."""
    kept = table_property(spark, table, _LOADED_UNTIL)
    if kept is not None:
        return int(kept)
    return spark.table(table).agg(F.coalesce(F.unix_micros(F.max(column)), F.lit(0))).first()[0]


def since(landed: DataFrame, mark: int, column: str = "ingested_at", date: str = "ingest_date") -> DataFrame:
    """Landed rows strictly above ``mark``; whole ingest dates before it are not read."""
    at = F.timestamp_micros(F.lit(mark))
    rows = landed.where(F.col(column) > at)
    return rows.where(F.col(date) >= F.to_date(at)) if date in landed.columns else rows


def keep_mark(spark: SparkSession, table: str, mark: int) -> None:
    set_table_property(spark, table, _LOADED_UNTIL, str(mark))


def load_incrementally(
    spark: SparkSession,
    table: str,
    landed: DataFrame,
    derive: Callable[[DataFrame], DataFrame],
    key: str | Sequence[str] = "edit_id",
    sort_by: Sequence[str] = (),
    indexed: bool = False,
    logged: bool = False,
) -> None:
    """The scheduled load: ``derive`` of the landed rows above the table's high-water mark, upserted by key.

    The mark is kept with the table once the load is done. A load that dies before leaves the older
    mark, and the next one takes the same rows again, which changes nothing.
    """
    stage = new_work_dir(spark, "load")
    fresh = derive(since(landed, loaded_until(spark, table))).withColumn("edit_date", F.to_date("ts"))
    fresh.write.parquet(stage)
    new = spark.read.schema(fresh.schema).parquet(stage)
    newest = new.agg(F.unix_micros(F.max("ingested_at"))).first()[0]
    if newest is None:
        return
    incremental_upsert(spark, table, new, key=key, sort_by=sort_by, indexed=indexed, logged=logged, staged=True)
    keep_mark(spark, table, newest)
