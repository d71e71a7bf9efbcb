"""Which dates hold a key: an index kept beside a date-partitioned table, with Bloom filters in front of it.

Two tables, both partitioned by the bucket of a key's hash: ``<table>_keys`` (hash, date, load) and
``<table>_key_filters`` (load, block, blocks, bits). Each load appends its keys, so a key that moved has several
rows; the index may name dates that no longer hold a key, never miss one that does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.operators import bloom
from editpulse.session import new_work_dir
from editpulse.sources.lookups import set_table_property, table_exists, table_property

# Keys of one bucket when an index is built; a bucket is what a load reads at least.
_KEYS_PER_BUCKET, _MOST_BUCKETS = 2_000_000, 4096
# One filter for each bucket of each load.
_BY = ("load", "bucket")
# Loads after which the index is written anew, with the newest rows of each key alone.
LOADS_KEPT = 16

# Table property with the number of buckets and the indexed columns. A rebuilt table loses it, and so its index.
_INDEXED = "editpulse.key_index"


def keys_table(table: str) -> str:
    return f"{table}_keys"


def filters_table(table: str) -> str:
    return f"{table}_key_filters"


def buckets_of(spark: SparkSession, table: str, key: Sequence[str]) -> int | None:
    """The number of buckets of the table's index over exactly these columns; None without one."""
    kept = table_property(spark, table, _INDEXED)
    if not kept or not all(table_exists(spark, name) for name in (keys_table(table), filters_table(table))):
        return None
    buckets, columns = kept.split(":", 1)
    return int(buckets) if columns == ",".join(key) else None


def hashed(rows: DataFrame, key: Sequence[str], buckets: int, *more: str) -> DataFrame:
    """Distinct (bucket, key_hash, ...) of the rows; equal hashes of different keys only add dates."""
    code = F.xxhash64(*key)
    return rows.select(F.pmod(code, F.lit(buckets)).cast("int").alias("bucket"), code.alias("key_hash"), *more).distinct()


def _write(spark: SparkSession, table: str, keys: DataFrame, mode: str) -> None:
    """Store index rows, one file a bucket, ordered by hash so that row groups have narrow ranges."""
    stage = new_work_dir(spark, "keys")
    keys.write.parquet(stage)
    staged = spark.read.schema(keys.schema).parquet(stage)
    for name, rows, order in ((keys_table(table), staged, "key_hash"), (filters_table(table), bloom.filters_of(staged, _BY), "block")):
        columns = [c for c in rows.columns if c != "bucket"]
        sorted_rows = rows.select(*columns, "bucket").repartition("bucket").sortWithinPartitions("bucket", order)
        if mode == "append" and table_exists(spark, name):
            sorted_rows.write.insertInto(name)
        else:
            sorted_rows.write.mode("overwrite").format("parquet").partitionBy("bucket").saveAsTable(name)


def build_index(spark: SparkSession, table: str, key: Sequence[str], partition: str = "edit_date") -> None:
    """Index all stored rows: the one time that every key is read."""
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{_INDEXED}')")
    rows = spark.table(table)
    wanted = -(-rows.count() // _KEYS_PER_BUCKET)
    buckets = min(_MOST_BUCKETS, 8 << max(0, (wanted - 1) // 8).bit_length())
    keys = hashed(rows, key, buckets, partition).select("bucket", "key_hash", F.col(partition).alias("at"), F.lit(0).cast("bigint").alias("load"))
    _write(spark, table, keys, "overwrite")
    _finish(spark, table, key, buckets)


def _finish(spark: SparkSession, table: str, key: Sequence[str], buckets: int) -> None:
    set_table_property(spark, table, _INDEXED, f"{buckets}:{','.join(key)}")


def _last_load(spark: SparkSession, table: str) -> int:
    return spark.table(filters_table(table)).agg(F.coalesce(F.max("load"), F.lit(0))).first()[0]


def loads(spark: SparkSession, table: str) -> int:
    """Loads added since the index was written as a whole."""
    return _last_load(spark, table)


def add_keys(spark: SparkSession, table: str, rows: DataFrame, key: Sequence[str], buckets: int, partition: str = "edit_date") -> None:
    """Index rows that are about to be stored: before, so that the index never lacks a stored key."""
    load = _last_load(spark, table) + 1
    keys = hashed(rows, key, buckets, partition).select("bucket", "key_hash", F.col(partition).alias("at"), F.lit(load).cast("bigint").alias("load"))
    _write(spark, table, keys, "append")


def compact(spark: SparkSession, table: str, key: Sequence[str], buckets: int) -> None:
    """Write the index anew with the rows of each key's newest load alone.

    The index counts as absent meanwhile: if this dies, the next load builds it again. To be called between
    loads only: the dates of a load that did not finish must not push out the older ones.
    """
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{_INDEXED}')")
    stored = spark.table(keys_table(table))
    newest = stored.groupBy("bucket", "key_hash").agg(F.max("load").alias("load"))
    kept = stored.join(newest, ["bucket", "key_hash", "load"]).select("bucket", "key_hash", "at", F.lit(0).cast("bigint").alias("load"))
    _write(spark, table, kept, "overwrite")
    _finish(spark, table, key, buckets)


def _in_buckets(rows: DataFrame, buckets: Sequence[int]) -> DataFrame:
    return rows.where(F.col("bucket").isin(*buckets) if buckets else F.lit(False))


def _buckets(keys: DataFrame) -> list[int]:
    """No more than the index has buckets."""
    return sorted(r[0] for r in keys.select("bucket").distinct().collect())


def passed(spark: SparkSession, table: str, keys: DataFrame) -> DataFrame:
    """The (bucket, key_hash) of ``keys`` that a filter lets pass: all that are stored, and few others."""
    filters = _in_buckets(spark.table(filters_table(table)), _buckets(keys))
    return bloom.passing(keys, filters, _BY, ["bucket"])


def entries(spark: SparkSession, table: str, keys: DataFrame) -> DataFrame:
    """Index rows of the ``keys`` (bucket, key_hash); only buckets with a key that passed its filter are read."""
    candidates = new_work_dir(spark, "passed")
    passed(spark, table, keys).write.parquet(candidates)
    found = spark.read.schema("bucket int, key_hash bigint").parquet(candidates)
    return _in_buckets(spark.table(keys_table(table)), _buckets(found)).join(found, ["bucket", "key_hash"], "left_semi")


def dates_of(spark: SparkSession, table: str, keys: DataFrame) -> set:
    """The dates that may hold one of the ``keys``: no more than the table has partitions."""
    return {r[0] for r in entries(spark, table, keys).select("at").distinct().collect()}
