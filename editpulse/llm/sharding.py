"""Shards that each hold the corpus's mixture of sources."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm.tables import stratum, without


def _shuffled(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))))


def _numbered(rows: DataFrame, group: list[str], bucket: str, order: list[str], number: str, total: str) -> DataFrame:
    """Number rows 1..n within ``group`` in (bucket, order) order; ``total`` gets n.

    Only one bucket of one group meets in a task. The rows before a bucket come from a table of
    bucket sizes, which is a partial aggregate.
    """
    sizes = rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_size"))
    along = Window.partitionBy(*group).orderBy(bucket)
    placed = sizes.select(
        *group,
        bucket,
        (F.sum("_size").over(along) - F.col("_size")).alias("_before"),
        F.sum("_size").over(Window.partitionBy(*group)).alias(total),
    )
    inside = F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order))
    ranked = rows.withColumn("_inside", inside).join(placed, [*group, bucket])
    return ranked.withColumn(number, F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def interleave_shards(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", by: str = "source", seed: int = 20240229
) -> DataFrame:
    """Proportional stratified interleaving: all rows, with ``shard`` and a gapless ``slot`` from 0.

    Rows are shuffled within each source by a seeded hash of their key. Row r of n in its source gets
    the fractional rank (2r - 1) / 2n; sorted by it, every stretch of the corpus has each source's
    share to within a row or so. The order is cut into ``shards`` runs whose row counts differ by at
    most one.

    Both orders are numbered in buckets (hash prefixes, then equal ranges of the fractional rank),
    about as many as the square root of the rows, so a source with most of the rows is spread over
    all tasks. What ``docs`` carries is shuffled twice: select what the shards shall hold.

    Null sources are a source of their own; a null key counts as ''. Equal keys are ordered by a hash of
    the whole row, so repeated rows stay and are interchangeable. Empty tables give no rows. Input columns
    named shard or slot give way; other columns are kept, whatever their names.
    """
    docs = without(docs, ("shard", "slot"))
    names = docs.columns
    rows = docs.count()
    buckets = max(64, math.isqrt(rows))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        stratum(by).alias("_by"),
        _shuffled(seed, key).alias("_hash"),
        F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("_tie"),
    )
    prefix = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint")
    hashed = packed.withColumn("_bucket", F.floor(prefix * buckets / (1 << 32)).cast("int"))
    ranked = _numbered(hashed, ["_by"], "_bucket", ["_hash", "_tie"], "_rank", "_of").drop("_bucket")
    share = ranked.withColumn("_share", (2 * F.col("_rank") - 1) / (2 * F.col("_of")))
    cut = share.withColumn("_bucket", F.floor(F.col("_share") * buckets).cast("int")).withColumn("_all", F.lit(0))
    order = _numbered(cut, ["_all"], "_bucket", ["_share", "_by", "_rank"], "_place", "_rows")
    # Shard s holds the places from ceil(s * rows / shards) on, counted from 0.
    place = F.col("_place") - 1
    shard = F.expr(f"(_place - 1) * {shards} div _rows")
    first = F.expr(f"(((_place - 1) * {shards} div _rows) * _rows + {shards} - 1) div {shards}")
    return order.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in names],
        shard.cast("int").alias("shard"),
        (place - first).cast("bigint").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file; large shards become several files."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
