"""Near-duplicate documents by min-max hashing: each permutation gives a minimum and a maximum."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.batches import grouped, slices, spread, texts_of, words
from editpulse.llm.components import components
from editpulse.llm.minhash import band_hashes, bands_for, distinct_sets, list_array, mixed, shingle_hashes, word_hashes
from editpulse.llm.tables import stored

SHINGLE = 4
SIMILARITY, RECALL, ROWS = "0.8", 0.9999, 6
BANDS = bands_for(float(SIMILARITY), RECALL, ROWS)
# Two values come from each permutation.
PERMUTATIONS = (BANDS * ROWS + 1) // 2
# One task of the verification holds one block of at most about so many sets and shingles.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 18
_SEED = 40111


def minmax(values: np.ndarray, offsets: np.ndarray, permutations: int) -> np.ndarray:
    """(texts with shingles, 2 * permutations): the minima under all permutations, then the maxima.

    Two sets agree in a minimum with the probability of their Jaccard similarity, and so they do in a maximum.
    """
    filled = np.flatnonzero(np.diff(offsets))
    out = np.empty((len(filled), 2 * permutations), np.uint32)
    if not len(filled):
        return out
    starts = offsets[filled]
    high, low = (values >> np.uint64(32)).astype(np.uint32), values.astype(np.uint32)
    odd = np.random.default_rng(_SEED).integers(1 << 31, size=(permutations, 2)).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    for k, (a, b) in enumerate(odd):
        order = high * a + low * b
        out[:, k] = np.minimum.reduceat(order, starts)
        out[:, permutations + k] = np.maximum.reduceat(order, starts)
    return out


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")


def _shingles(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingles of all texts, offsets by text, hash of each text's word sequence)"""
    split = words(pc.ascii_lower(texts_of(batch, "text")))
    hashes = word_hashes(split)
    place = (np.arange(len(hashes)) - np.repeat(split.offsets[:-1], split.counts)).astype(np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed(hashes ^ mixed(place)))))
    node = mixed((sums[split.offsets[1:]] - sums[split.offsets[:-1]]) ^ split.counts.astype(np.uint64))
    return *distinct_sets(*shingle_hashes(hashes, split.offsets, SHINGLE)), node


def signatures(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, tie (hash of its text), node (hash of its lower-cased words), size (distinct shingles), bands."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets, node = _shingles(batch)
            size = np.diff(offsets)
            bands = band_hashes(minmax(values, offsets, PERMUTATIONS), BANDS, ROWS)
            ends = np.concatenate(([0], np.cumsum(np.where(size > 0, BANDS, 0))))
            columns = [batch.column("doc_id"), batch.column("tie"), pa.array(node.view(np.int64)), pa.array(size), list_array(bands.ravel(), ends)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "node", "size", "bands"])

    return _plain(docs).mapInArrow(rows, "doc_id bigint, tie bigint, node bigint, size bigint, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted (node, doc_id, tie), one row of the documents for each: no copies meet."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets, node = _shingles(batch)
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), list_array(values, offsets)], names=["node", "shingles"])

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    chosen = wanted.select(key.alias("_id"), F.col("tie").alias("_tie"))
    texts = _plain(docs).select(key.alias("_id"), F.col("tie").alias("_tie"), "text").join(chosen, ["_id", "_tie"], "left_semi")
    return texts.select("text").mapInArrow(rows, "node bigint, shingles array<bigint>").dropDuplicates(["node"])


def joined_sets(values: np.ndarray, offsets: np.ndarray, label: np.ndarray, least: Fraction) -> np.ndarray:
    """Labels after joining all sets whose exact Jaccard similarity is ``least`` or more.

    Only pairs with different labels are compared, so a group that is close to one set costs one pass.
    """
    sizes = np.diff(offsets)
    order = np.argsort(sizes, kind="stable")
    starts, sizes, root = offsets[:-1][order], sizes[order], label[order].copy()
    _, codes = np.unique(values, return_inverse=True)
    here = np.zeros(codes.max(initial=0) + 1, np.int32)
    up, down = least.numerator, least.denominator
    for i in range(len(order) - 1):
        stop = int(np.searchsorted(sizes, sizes[i] * down // up, side="right"))
        others = i + 1 + np.flatnonzero(root[i + 1 : stop] != root[i])
        if not len(others):
            continue
        own = codes[starts[i] : starts[i] + sizes[i]]
        here[own] = 1
        many = sizes[others]
        shared = np.add.reduceat(here[codes[spread(starts[others], many)]], np.cumsum(many) - many).astype(np.int64)
        here[own] = 0
        near = others[(up + down) * shared >= up * (sizes[i] + many)]
        if len(near):
            root[np.isin(root, root[near])] = root[i]
    out = np.empty_like(root)
    out[order] = root
    return out


_DEAL = ("leader", "block", "chunk")


def _joined(dealt: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """Edges (a, b) between old labels that verification joined, for (leader, block, chunk, node, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, _DEAL):
            label = group["label"].to_numpy()
            lists = group["shingles"].combine_chunks()
            offsets = lists.offsets.to_numpy().astype(np.int64)
            after = joined_sets(lists.flatten().to_numpy(), offsets - offsets[0], label, least)
            a, b = np.unique(np.stack([label, after]), axis=1)
            moved = a != b
            yield pa.RecordBatch.from_arrays([pa.array(a[moved]), pa.array(b[moved])], names=["a", "b"])

    rows = dealt.join(sets, "node").select(*_DEAL, "label", "shingles")
    return rows.repartition(*_DEAL).sortWithinPartitions(*_DEAL).mapInArrow(run, "a bigint, b bigint")


def near_groups(spark: SparkSession, texts: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: str = SIMILARITY) -> DataFrame:
    """(node, root) of all texts linked to another one; root is the smallest node reachable.

    ``texts``: distinct (node, size, bands). ``sets_of`` gives (node, shingles) of a table of nodes.

    The smallest node of a bucket leads it. A leader's nodes are dealt into blocks, and the leader goes
    to each of them, so a group of near copies becomes one component in one round, each set sent once. In
    groups of several blocks, nodes outside the largest component then meet every block: all pairs that
    share a leader have been compared, or lie in one component already.
    """
    least = Fraction(similarity)
    rows = texts.where("size > 0").select("node", F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("_last")).where("leader != _last")
    star = stored(spark, rows.join(buckets.select("bucket", "leader"), "bucket").select("leader", "node").distinct(), "star")
    sets = stored(spark, sets_of(star.select("node").distinct()), "sets")

    sized = star.join(texts.select("node", "size"), "node")
    many = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    blocks = stored(spark, sized.groupBy("leader").agg(many.alias("blocks")), "blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = star.join(blocks, "leader").withColumn("block", own)
    everywhere = F.when(F.col("node") == F.col("leader"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    dealt = placed.select("leader", F.explode(everywhere).alias("block"), F.lit(0).alias("chunk"), "node", F.col("node").alias("label"))
    edges = stored(spark, _joined(dealt, sets, least), "links")
    roots = components(spark, edges)

    wide = placed.where("blocks > 1").join(roots, "node", "left").withColumn("label", F.coalesce("root", "node"))
    wide = stored(spark, wide.select("leader", "node", "block", "blocks", "label"), "wide")
    largest = wide.groupBy("leader", "label").count().groupBy("leader").agg(F.max_by("label", F.struct("count", "label")).alias("_largest"))
    strays = stored(spark, wide.join(largest, "leader").where("label != _largest").drop("_largest"), "strays")
    if strays.isEmpty():
        return roots
    chunks = strays.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("chunks"))
    sent = strays.join(chunks, "leader").select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int").alias("chunk"), "node", "label",
    )
    met = wide.join(chunks, "leader").select("leader", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "node", "label")
    more = stored(spark, _joined(sent.unionByName(met).distinct(), sets, least), "links")
    return components(spark, edges.unionByName(more).unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def minmax_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are runs of characters other than space and U+0009 to U+000D, A to Z lower-cased. A document's set is
    its distinct runs of 4 words; with fewer words, the whole sequence. Documents are linked if their sets
    have Jaccard similarity 0.8 or more; component_id is the smallest doc_id reachable, kept says it is the own one.

    Signatures hold the minimum and the maximum under each of 93 permutations: 31 bands of 6 rows, in which a pair
    at 0.8 meets with probability 0.9999. Whatever meets is decided on full sets of 64-bit shingle hashes.
    Documents with equal words are one node before anything is compared.

    Null and empty texts, and those without words, have no shingles and are linked with nothing, not with each
    other either. Null doc_ids give way to any other id of their component; a component of nulls only has a null id
    and all its rows are kept. Repeated rows are copies of each other and share their id, so all are kept or none.
    Other columns are not read.
    """
    signed = stored(spark, signatures(docs), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie"))
    grouped_texts = signed.where("size > 0").groupBy("node").agg(first.alias("first"), F.max("size").alias("size"), F.any_value("bands").alias("bands"))
    texts = stored(spark, grouped_texts.select("node", "size", "bands", "first.doc_id", "first.tie"), "texts")

    def sets_of(nodes: DataFrame) -> DataFrame:
        return _sets(docs, texts.select("node", "doc_id", "tie").join(nodes, "node", "left_semi"))

    roots = near_groups(spark, texts.select("node", "size", "bands"), sets_of)
    named = texts.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = named.join(least, "root").select("node", "component_id", F.lit(True).alias("_known"))
    labelled = signed.select("doc_id", "node", F.col("size").alias("n_shingles")).join(known, "node", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("_known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return labelled.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
