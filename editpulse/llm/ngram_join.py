"""Near-duplicate documents: a Jaccard self-join on word 5-grams through MinHash bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm import minhash
from editpulse.llm.batches import slices, texts_of, words
from editpulse.llm.tables import stored

SIMILARITY, RECALL, ROWS = "0.8", 0.9999, 6
BANDS = minhash.bands_for(float(SIMILARITY), RECALL, ROWS)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")


def _node(texts: pa.Array) -> np.ndarray:
    """A 64-bit hash of each text's word sequence."""
    of = xxhash.xxh3_64_intdigest
    return np.fromiter((of(b" ".join(t.split())) for t in texts.cast(pa.large_binary()).to_pylist()), np.uint64, len(texts))


def signatures(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, tie (hash of its text), node (hash of its word sequence), size (shingles), bands (none without words)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = texts_of(batch, "text")
            split = words(texts)
            values, offsets = minhash.shingle_hashes(minhash.word_hashes(split), split.offsets)
            size = np.diff(offsets)
            bands = minhash.band_hashes(minhash.minhashes(values, offsets, BANDS * ROWS), BANDS, ROWS)
            ends = np.concatenate(([0], np.cumsum(np.where(size > 0, BANDS, 0))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tie"),
                    pa.array(_node(texts).view(np.int64)),
                    pa.array(size),
                    minhash.list_array(bands.ravel(), ends),
                ],
                names=["doc_id", "tie", "node", "size", "bands"],
            )

    return _plain(docs).mapInArrow(rows, "doc_id bigint, tie bigint, node bigint, size bigint, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted (node, tie): only their texts are shuffled on."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            split = words(texts_of(batch, "text"))
            sets = minhash.distinct_sets(*minhash.shingle_hashes(minhash.word_hashes(split), split.offsets))
            yield pa.RecordBatch.from_arrays([batch.column("node"), minhash.list_array(*sets)], names=["node", "shingles"])

    found = _plain(docs).select("tie", "text").join(wanted, "tie").dropDuplicates(["tie"]).select("node", "text")
    return found.mapInArrow(rows, "node bigint, shingles array<bigint>")


def ngram_join(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, tie (hash of the text), text_id, class_id, class_tie (the class's own number), n_copies, n_texts, n_links.

    Words are runs of characters other than space and U+0009 to U+000D. Documents with the same word
    sequence are one text; text_id is the smallest doc_id of it, n_copies its other rows. Two texts are
    linked if their sets of word 5-grams have Jaccard similarity 0.8 or more; n_texts counts a text's
    links, n_links all other rows that a row is linked to, copies included. class_id is the smallest
    doc_id of the connected texts.

    Bands of 6 rows, as many as make a pair at 0.8 meet with probability 0.9999 (31); every pair that
    meets is verified on its full sets of 64-bit shingle hashes. Copies are merged before anything is
    compared, whole texts are read twice, and the second reading shuffles only (doc_id, text).

    Null and empty texts, and those without words, have no shingles: they are one text with copies and
    link to nothing else. A text of fewer than five words has itself as its only shingle. Null doc_ids
    count as one document id in the ids given out. Repeated rows are copies. Other columns are not read.
    """
    signed = stored(spark, signatures(docs), "signatures")
    grouped = signed.groupBy("node", "size", "bands").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"), F.min("tie").alias("tie")
    )
    texts = stored(spark, grouped, "texts")

    def sets_of(nodes: DataFrame) -> DataFrame:
        return _sets(docs, texts.select("node", "tie").join(nodes, "node"))

    found = minhash.linked_texts(spark, texts.where("size > 0").select("node", "bands"), texts.select("node", "copies", "size"), sets_of, SIMILARITY)
    links = found.select("node", "root", F.col("texts").alias("_texts"), F.col("rows").alias("_rows"))
    joined = texts.select("node", "doc_id", "copies").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = joined.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    labelled = joined.join(classes, "root").select(
        "node",
        F.col("doc_id").alias("text_id"),
        "class_id",
        F.col("root").alias("class_tie"),
        (F.col("copies") - 1).alias("n_copies"),
        F.coalesce("_texts", F.lit(0)).alias("n_texts"),
        (F.coalesce("_rows", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return signed.select("doc_id", "tie", "node").join(labelled, "node").drop("node")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id (nulls first), then the smallest hash of its text."""
    first = ngram_join(spark, docs).groupBy("class_id", "class_tie").agg(F.min(F.struct("doc_id", "tie")).alias("_first"))
    key = F.coalesce(F.col("_first.doc_id").cast("string"), F.lit(""))
    chosen = first.select(key.alias("_id"), F.col("_first.tie").alias("_tie")).distinct()
    names = docs.columns
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("")), "_tie": F.xxhash64("text")})
    return keyed.join(chosen, ["_id", "_tie"], "left_semi").dropDuplicates(["_id", "_tie"]).select(*[F.col(f"`{c}`") for c in names])
