"""Blocked Bloom filters as tables of bitmaps, in SQL functions alone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark's bitmap functions make bitmaps of so many bits: a block of a filter. With ten bits for a key and four
# probes, about one key in eighty that is not there passes.
BLOCK_BITS, KEYS_PER_BLOCK, PROBES = 32768, 3200, 4


def _block(blocks: Column) -> Column:
    return F.pmod(F.shiftright("key_hash", 8), blocks).cast("int")


def _probes() -> list[Column]:
    return [F.pmod(F.xxhash64("key_hash", F.lit(probe)), F.lit(BLOCK_BITS)) for probe in range(PROBES)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0


def filters_of(keys: DataFrame, by: Sequence[str]) -> DataFrame:
    """The filters of ``keys`` (``by`` and key_hash), one for each value of ``by``: by, blocks, block, bits.

    A filter has as many blocks as its keys need, and each key one block. Keys are dealt by block before the bitmaps are made:
    made in each task and combined, there would be about as many bitmaps as tasks times blocks. ``by`` has few values (one row each
    is broadcast), which may hold any number of keys.
    """
    sizes = keys.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / KEYS_PER_BLOCK).cast("int").alias("blocks"))
    placed = keys.join(F.broadcast(sizes), list(by)).withColumn("block", _block(F.col("blocks")))
    bits = placed.repartition(*by, "blocks", "block").select(*by, "blocks", "block", F.explode(F.array(*_probes())).alias("place"))
    return bits.groupBy(*by, "blocks", "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def passing(keys: DataFrame, filters: DataFrame, by: Sequence[str], shared: Sequence[str]) -> DataFrame:
    """The ``keys`` (``shared`` and key_hash) that a filter with their ``shared`` values lets pass: all it holds, and few others."""
    sizes = filters.select(*by, "blocks").distinct()
    asked = keys.join(F.broadcast(sizes), list(shared)).withColumn("block", _block(F.col("blocks")))
    met = asked.join(filters.drop("blocks"), [*by, "block"])
    return met.where(reduce(Column.__and__, [_is_set(F.col("bits"), place) for place in _probes()])).select(*shared, "key_hash").distinct()
