"""Stored tables: namespaces, layout, full rebuilds, month loads, descriptions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.operators.upsert import add_missing, in_order, overwrite_partitions

NAMESPACES = {
    "raw": "Append-only landing tables of the stream and the batch loads.",
    "core": "Star schema: dimensions and facts built from raw.",
    "marts": "Analytical tables built from core.",
}


@dataclass(frozen=True)
class Layout:
    """Where rows of a table lie: partition folders, then the order inside the files.

    Sorted files give each Parquet row group a narrow value range, so time-range and key look-ups
    skip most of them. ``sort_by`` has columns or SQL expressions.
    """

    partition_by: tuple[str, ...] = ()
    derived: Mapping[str, str] | None = None  # partition column -> SQL expression
    sort_by: tuple[str, ...] = ()
    # False where the rows already come range-split in a fitting order.
    split: bool = True
    # Columns with a Bloom filter in each row group, for look-ups by one value.
    bloom: tuple[str, ...] = ()

    def options(self) -> dict[str, str]:
        """Writer options; a catalog table created with them keeps them for later inserts."""
        return {f"parquet.bloom.filter.enabled#{column}": "true" for column in self.bloom}


def interleaved(codes: Sequence[str], bits: int = 8) -> str:
    """SQL of a space-filling order: the bits of several codes of 0 to 2^bits - 1 in turn, the highest first.

    Rows near in it are near in every code, so a row group has a narrow range of each.
    """
    places = [(bit, k) for bit in range(bits) for k in range(len(codes))]
    parts = [f"shiftleft(shiftright({codes[k]}, {bit}) & 1L, {bit * len(codes) + len(codes) - 1 - k})" for bit, k in places]
    return f"({' + '.join(parts)})"


def key_code(column: str) -> str:
    """The highest eight bits of a hash key, in its order."""
    return f"coalesce(shiftright({column}, 56) + 128, 0)"


def name_code(column: str) -> str:
    """A code of a name's first two letters, in their order."""
    first, second = (f"least(greatest(ascii(substr({column}, {at}, 1)) - 97, 0), 25)" for at in (1, 2))
    return f"coalesce(cast({first} * 9 + {second} div 3 AS bigint), 0)"


def clock_code(column: str) -> str:
    """A code of the time of day."""
    return f"coalesce(pmod(unix_seconds({column}), 86400) * 256 div 86400, 0)"


# Marts lie by date, so that a load replaces only the dates it changed.
_BY_MINUTE = ("mart_date",), {"mart_date": "to_date(minute_bucket)"}
_BY_WINDOW = ("mart_date",), {"mart_date": "to_date(window_start)"}

LAYOUTS: dict[str, Layout] = {
    "raw.stg_edit": Layout(
        ("edit_date", "ingest_date"),
        {"edit_date": "to_date(ts)", "ingest_date": "to_date(ingested_at)"},
        ("ts", "edit_id"),
    ),
    "raw.stg_clickstream": Layout(("wiki_db", "dump_month")),
    "core.dim_time": Layout(sort_by=("ts",)),
    "core.dim_wiki": Layout(sort_by=("wiki_id",)),
    "core.dim_page": Layout(sort_by=("page_id",)),
    "core.dim_editor": Layout(sort_by=("editor_id",)),
    # Look-ups come by page, editor, wiki and time alike.
    "core.fact_edit": Layout(
        ("edit_date",),
        {"edit_date": "to_date(ts)"},
        (interleaved([key_code("page_id"), key_code("editor_id"), name_code("wiki_id"), clock_code("ts")]), "page_id", "ts", "edit_id"),
        bloom=("page_id", "editor_id"),
    ),
    "core.fact_clickstream": Layout(("wiki_id", "dump_month"), None, ("target_page_id", "fc_id"), split=False),
    "marts.live_tiles": Layout(("tile_date",), {"tile_date": "to_date(tile_end)"}, ("tile_end", "wiki_db")),
    "marts.trending_per_minute": Layout(*_BY_MINUTE, ("minute_bucket", "rank_in_minute", "page_id")),
    "marts.edit_velocity": Layout(*_BY_MINUTE, ("minute_bucket", "page_id")),
    "marts.edit_velocity_60min": Layout(*_BY_MINUTE, ("minute_bucket", "page_id")),
    "marts.vandalism_candidates": Layout(*_BY_WINDOW, ("window_start", "page_id")),
    "marts.vandalism_sliding": Layout(*_BY_WINDOW, ("window_start", "page_id")),
}


def layout_for(table: str) -> Layout:
    """The layout of ``namespace.table``; unknown tables have none."""
    return LAYOUTS.get(table, Layout())


def arrange(rows: DataFrame, layout: Layout) -> DataFrame:
    """Rows with derived partition columns, range-split and sorted for the layout.

    The split covers the sort columns too, so one busy day, month or page spreads over many files.
    """
    for name, expression in (layout.derived or {}).items():
        rows = rows.withColumn(name, F.expr(expression))
    return in_order(rows, layout.partition_by, layout.sort_by, layout.split) if layout.sort_by else rows


def create_namespaces(spark: SparkSession, location: str | None = None, prefix: str = "") -> None:
    """raw, core and marts; ``prefix`` keeps several warehouses apart in one catalog."""
    for name, comment in NAMESPACES.items():
        where = f" LOCATION '{location.rstrip('/')}/{prefix}{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{name} COMMENT '{comment}'{where}")


def materialize_table(
    rows: DataFrame, table: str, layout: Layout | None = None, describe: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> None:
    """Full rebuild of a catalog table; ``describe`` adds column comments to what is stored."""
    layout = layout_for(table) if layout is None else layout
    writer = describe(arrange(rows, layout)).write.mode("overwrite").format("parquet").options(**layout.options())
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer.saveAsTable(table)


def materialize_view(rows: DataFrame, name: str) -> None:
    rows.createOrReplaceTempView(name)


def seed_if_absent(spark: SparkSession, rows: DataFrame, table: str, key: str) -> None:
    """Add the seed rows whose key is not stored yet; the first call creates the table."""
    if not spark.catalog.tableExists(table):
        materialize_table(rows, table)
        return
    target = spark.table(table)
    add_missing(target, rows.select(*target.columns), key).write.insertInto(table)


def land(rows: DataFrame, table: str) -> None:
    """Append rows to a stored table, in its layout: derived columns are added, others must be there."""
    columns = rows.sparkSession.table(table).columns
    known = next((layout for name, layout in LAYOUTS.items() if table.endswith(name)), Layout())
    arrange(rows, known).select(*columns).write.insertInto(table)


def land_clickstream(spark: SparkSession, rows: DataFrame, table: str = "raw.stg_clickstream", mode: str = "append") -> None:
    """Land one dump. ``append`` adds rows on every call; ``replace_month`` makes a rerun harmless."""
    if mode not in ("append", "replace_month"):
        raise ValueError(f"mode must be 'append' or 'replace_month', not {mode!r}")
    partition_by = layout_for("raw.stg_clickstream").partition_by
    if not spark.catalog.tableExists(table):
        rows.write.format("parquet").partitionBy(*partition_by).saveAsTable(table)
    elif mode == "append":
        rows.select(*spark.table(table).columns).write.insertInto(table)
    else:
        overwrite_partitions(spark, table, rows)


def persist_docs(
    spark: SparkSession, table: str, description: str | None = None, columns: Mapping[str, str] | None = None
) -> None:
    """Store table and column descriptions in the catalog."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    if description:
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(description)}")
    for column, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {quoted(text)}")
