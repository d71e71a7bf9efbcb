"""Row numbers and ranks that never put an unbounded group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editpulse.session import new_work_dir

# Copies of one row written out by one task, and by one step of a large group of copies.
_COPIES_PER_STEP = 100_000
# A group with more rows than this is not shuffled to one task, but to as many as there are parts.
_HOT_ROWS = 1_000_000
_HOT_PARTS = 4096


def _write_out_copies(counted: DataFrame, copies: str, copy_no: str, step: int) -> DataFrame:
    """One row per copy, numbered from 0; large groups of copies are cut into steps and spread."""
    few = counted.where(F.col(copies) <= step).withColumn(
        copy_no, F.explode(F.expr(f"sequence(0L, {copies} - 1)"))
    )
    many = (
        counted.where(F.col(copies) > step)
        .withColumn("_step", F.explode(F.expr(f"sequence(0L, ({copies} - 1) div {step})")))
        .repartition(*counted.columns, "_step")
        .withColumn(
            copy_no,
            F.explode(F.expr(f"sequence(_step * {step}, least((_step + 1) * {step}, {copies}) - 1)")),
        )
        .drop("_step")
    )
    return few.unionByName(many).drop(copies)


def number_rows(
    spark: SparkSession,
    rows: DataFrame,
    order_by: Sequence[str],
    number: str,
    work_dir: str | None = None,
    copies_per_step: int = _COPIES_PER_STEP,
) -> DataFrame:
    """Number all rows 1..n in ``order_by`` order, breaking ties by the remaining columns.

    The rows are range-partitioned, sorted and written once to the shared folder with their
    position inside the partition; the number adds the sizes of the partitions before it. Equal
    rows are counted first and written out again with a copy number, so the sort key is unique
    and even one row that makes up most of the input spreads over many ranges.
    """
    columns = rows.columns
    rest = [c for c in columns if c not in order_by]
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    single = _write_out_copies(counted, "_copies", "_copy", copies_per_step)
    path = work_dir or new_work_dir(spark, "numbered")
    placed = single.orderBy(*order_by, *rest, "_copy").drop("_copy")
    placed.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)

    stored = spark.read.parquet(path)
    part, offset = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per written partition: bounded by the shuffle width, so window and broadcast are safe.
    sizes = stored.groupBy(part.alias("_part")).agg((F.max(offset) + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    numbered = stored.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.select((F.col("_start") + offset + 1).alias(number), *columns)


def rank_by_count(
    rows: DataFrame,
    count: str,
    outer: Sequence[str],
    inner: Sequence[str],
    rank: str,
    dense_rank: str,
    spread_by: str,
    hot_rows: int = _HOT_ROWS,
) -> DataFrame:
    """RANK by ``count`` (descending) within ``outer`` and DENSE_RANK within ``outer + inner``.

    A rank depends only on how many rows have a higher count, so it is computed on the histogram
    of counts, which is small: d distinct counts need at least d*d/2 edits. The ranks go back to
    the rows by an equi-join on (outer, inner, count). Combinations with more than ``hot_rows``
    rows get theirs from a table of their own (Spark broadcasts it where its size allows), and
    are spread by the hash of ``spread_by`` over the shuffle of the join they do not need.
    """
    keys = [*outer, *inner, count]
    histogram = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    higher = Window.partitionBy(*outer).orderBy(F.desc(count)).rangeBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*outer, *inner).orderBy(F.desc(count))
    ranks = histogram.select(
        *keys,
        "_rows",
        F.struct(
            (F.coalesce(F.sum("_rows").over(higher), F.lit(0)) + 1).alias(rank),
            F.dense_rank().over(within).cast("bigint").alias(dense_rank),
        ).alias("_ranks"),
    )
    hot = ranks.where(F.col("_rows") > hot_rows).select(*keys, F.col("_ranks").alias("_hot"))
    # A hot combination has its ranks in part -1, where no row looks for them.
    home = F.when(F.col("_rows") > hot_rows, -1).otherwise(0)
    usual = ranks.select(*keys, home.alias("_part"), "_ranks")
    part = F.when(F.col("_hot").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread_by), F.lit(_HOT_PARTS)) + 1)
    marked = rows.join(hot, keys, "left").withColumn("_part", part.cast("int"))
    found = marked.join(usual, [*keys, "_part"], "left").withColumn("_ranks", F.coalesce("_hot", "_ranks"))
    return found.select(*rows.columns, f"_ranks.{rank}", f"_ranks.{dense_rank}")


def latest_per_key(rows: DataFrame, key: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The newest row of each key (ties by the remaining columns), combined before the shuffle."""
    rest = [c for c in rows.columns if c not in (*key, *newest_by)]
    return _pick(rows, key, F.max(F.struct(*newest_by, *rest)))


def first_per_key(rows: DataFrame, key: Sequence[str], oldest_by: Sequence[str]) -> DataFrame:
    """The oldest row of each key (ties by the remaining columns), combined before the shuffle."""
    rest = [c for c in rows.columns if c not in (*key, *oldest_by)]
    return _pick(rows, key, F.min(F.struct(*oldest_by, *rest)))


def _pick(rows: DataFrame, key: Sequence[str], picked: Column) -> DataFrame:
    chosen = rows.groupBy(*key).agg(picked.alias("_row"))
    return chosen.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in rows.columns])
