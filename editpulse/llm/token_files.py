"""Token ids as ORC files in document order, and reading them back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editpulse.llm.batches import slices, texts_of
from editpulse.llm.tokenizing import encoder, with_end

FILE_SCHEMA = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, stripe_mb: int = 64) -> None:
    """Encode each whole text (null: empty), append ``end_id`` and write ids as ORC in ascending doc_id order.

    One range-partitioned shuffle of (doc_id, text); each task sorts its range, encodes it and writes
    one file. Ids are an integer list, which ORC stores run-length encoded; every stripe has row
    indexes, and a Bloom filter on doc_id, so readers can skip files, stripes and row groups by document.
    A row also has the number of its file and the ids before it there.

    Null ids come first; equal ids are ordered by the hash of their text. Repeated rows stay; they may
    lie in several files. An empty table gives a folder without rows. Other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids, offsets = with_end(*encoder(tokenizer)(texts_of(batch, "text")), end_id)
            counts = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(before + offsets[:-1]),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32))),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            before += len(ids)

    # The last key only keeps many copies of one row from meeting in one range.
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("_tie"),
        F.monotonically_increasing_id().alias("_row"),
    )
    keys = ("doc_id", "_tie", "_row")
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    (
        ordered.mapInArrow(encode, FILE_SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("orc.stripe.size", str(stripe_mb << 20))
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, part_start, n_tokens and ids. Filters on doc_id skip stripes; columns not asked for are not read."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
            raw = np.ascontiguousarray(values.astype("<u4", copy=False))
            crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            kept = [batch.column(c) for c in ("doc_id", "part", "part_start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(crc, pa.int64())], names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"]
            )

    files = read_token_files(spark, path)
    sizes = files.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("_size"))
    # One row per file, so this window and the table joined are as short as the list of files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    summed = files.mapInArrow(sums, "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids_crc32 bigint")
    return summed.join(starts, "part").select(
        "doc_id", (F.col("_before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
