"""MinHash signatures, candidate groups from shared bands, and exact verification inside tasks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.batches import Words, spread
from editpulse.llm.components import components
from editpulse.llm.tables import stored

SHINGLE = 5
# A verification task holds two blocks of at most so many sets and shingles.
BLOCK_SETS, BLOCK_SHINGLES = 4096, 1 << 20
_SEED = 8191


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """The least number of bands of ``rows`` rows in which a pair of that similarity meets with ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values, spread one-to-one over 64 bits."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(split: Words) -> np.ndarray:
    """A 64-bit hash for each word of the batch, the same in every task."""
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, split.vocabulary.to_numpy(zero_copy_only=False)), np.uint64, len(split.vocabulary))
    return each[split.codes]


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and their offsets by text.

    A text with fewer words has one shingle, its whole word sequence; a text without words has none.
    """
    counts = np.diff(offsets)
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.concatenate(([0], np.cumsum(many)))
    starts = spread(offsets[:-1], many)
    length = np.repeat(np.minimum(counts, size), many)
    padded = np.concatenate((hashes, np.zeros(size, np.uint64)))
    value = mixed(length.astype(np.uint64))
    for step in range(size):
        word = np.where(step < length, padded[starts + step], np.uint64(0))
        value = mixed((value ^ word) + np.uint64(step))
    return value, ends


def minhashes(values: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """(texts with shingles, count) minima; the rows of texts without shingles are left out."""
    filled = np.flatnonzero(np.diff(offsets))
    if not len(filled):
        return np.zeros((0, count), np.uint32)
    starts = offsets[filled]
    x = (values >> np.uint64(32)).astype(np.uint32)
    low = values.astype(np.uint32)
    rng = np.random.default_rng(_SEED)
    out = np.empty((len(filled), count), np.uint32)
    for k in range(count):
        a, b = np.uint32(rng.integers(1 << 31) * 2 + 1), np.uint32(rng.integers(1 << 31) * 2 + 1)
        out[:, k] = np.minimum.reduceat(x * a + low * b, starts)
    return out


def band_hashes(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) 64-bit hashes; a band's number is part of its hash."""
    out = np.empty((len(minima), bands), np.uint64)
    for band in range(bands):
        value = np.full(len(minima), band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            value = mixed(value ^ minima[:, k].astype(np.uint64))
        out[:, band] = value
    return out


def distinct_sets(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, with offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return v[first], np.concatenate(([0], np.cumsum(np.bincount(o[first], minlength=len(offsets) - 1))))


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def verified(
    node: np.ndarray, copies: np.ndarray, block: np.ndarray, sets: tuple[np.ndarray, np.ndarray],
    lower: list[np.ndarray], across: bool, least: Fraction,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of one block pair by exact Jaccard: texts linked, rows linked, and a root for each set.

    ``lower`` has the earlier groups of each set: a pair that shares one is counted there. ``across``:
    only pairs of different blocks count.
    """
    values, offsets = sets
    order = np.argsort(np.diff(offsets), kind="stable")
    sizes = np.diff(offsets)[order]
    _, codes = np.unique(values, return_inverse=True)
    codes = codes[spread(offsets[:-1][order], sizes)]
    o = np.concatenate(([0], np.cumsum(sizes)))
    m = len(order)
    texts, rows, root = np.zeros(m, np.int64), np.zeros(m, np.int64), np.arange(m)
    weight, part = copies[order], block[order]
    names, where = np.unique(np.concatenate([*lower, np.zeros(0, np.int64)]), return_inverse=True)
    widest = max(map(len, lower), default=0)
    earlier = np.full((m, widest), len(names), np.int64)
    at = 0
    place = np.argsort(order)
    for k, some in enumerate(lower):
        earlier[place[k], : len(some)] = where[at : at + len(some)]
        at += len(some)
    here, seen = np.zeros(codes.max(initial=0) + 1, np.int32), np.zeros(len(names) + 1, bool)
    up, down = least.numerator, least.denominator
    for i in range(m - 1):
        stop = int(np.searchsorted(sizes, sizes[i] * down // up, side="right"))
        if stop <= i + 1:
            continue
        own = codes[o[i] : o[i + 1]]
        here[own] = 1
        shared = np.add.reduceat(here[codes[o[i + 1] : o[stop]]], o[i + 1 : stop] - o[i + 1])
        here[own] = 0
        near = i + 1 + np.flatnonzero((up + down) * shared.astype(np.int64) >= up * (sizes[i] + sizes[i + 1 : stop]))
        if across:
            near = near[part[near] != part[i]]
        if widest and len(near):
            seen[earlier[i]] = True
            seen[-1] = False
            counted = seen[earlier[near]].any(axis=1)
            seen[earlier[i]] = False
            near = near[~counted]
        if not len(near):
            continue
        texts[i] += len(near)
        rows[i] += weight[near].sum()
        texts[near] += 1
        rows[near] += weight[i]
        joined = np.unique(np.append(root[near], root[i]))
        if len(joined) > 1:
            root[np.isin(root, joined)] = joined[0]
    return texts[place], rows[place], node[order][root][place]


def _verify_task(least: Fraction) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["node", "texts", "rows", "root"]

    def groups(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        key = np.stack([table[c].to_numpy() for c in ("leader", "first", "second")])
        node, copies, block = (table[c].to_numpy() for c in ("node", "copies", "block"))
        sets, leaders = table["shingles"].combine_chunks(), table["leaders"].combine_chunks()
        sv, so = sets.flatten().to_numpy(), sets.offsets.to_numpy().astype(np.int64)
        lv, lo = leaders.flatten().to_numpy(), leaders.offsets.to_numpy().astype(np.int64)
        so, lo = so - so[0], lo - lo[0]
        cuts = np.concatenate(([0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [len(node)]))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a < 2:
                continue
            leader, across = key[0, a], key[1, a] != key[2, a]
            lower = [x[x < leader] for x in (lv[lo[k] : lo[k + 1]] for k in range(a, b))]
            inside = sv[so[a] : so[b]], so[a : b + 1] - so[a]
            texts, rows, root = verified(node[a:b], copies[a:b], block[a:b], inside, lower, across, least)
            hit = texts > 0
            out.append((node[a:b][hit], texts[hit], rows[hit], root[hit]))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("leader", "first", "second")])
            changes = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            # Rows from here on belong to a group that may go on in the next batch.
            start = int(changes[-1]) if len(changes) else 0
            if len(changes) or (last is not None and last != tuple(key[:, 0])):
                head = batch.slice(0, start)
                done = pa.Table.from_batches([*held, head]) if start else pa.Table.from_batches(held)
                yield groups(done)
                held = []
            held.append(batch.slice(start))
            last = tuple(key[:, -1])
        if held:
            yield groups(pa.Table.from_batches(held))

    return run


def linked_texts(
    spark: SparkSession, bands: DataFrame, texts: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: str = "0.8"
) -> DataFrame:
    """All pairs of texts that share a band and have Jaccard ``similarity`` or more, summed per text.

    ``bands``: node bigint, bands array<bigint>; a node may come repeatedly.
    ``texts``: node bigint, copies bigint (rows it stands for), size bigint (shingles), once for each node.
    ``sets_of``: for a table of distinct nodes, their (node, shingles array<bigint>), distinct shingles.
    Gives node, texts (other texts linked), rows (rows those stand for), root (smallest node of its
    component); only for texts with a link.

    The smallest node of a band bucket leads it; every node gets the distinct leaders of its buckets,
    which are one or two for a group of near copies however many bands it shares. Pairs are verified
    among the nodes of a leader, each pair once, in tasks that each hold two blocks of a group; only
    sums and one tree edge per set leave them, never pairs. A group of m different texts, all close
    to each other, is compared in (m / 4096)^2 / 2 tasks.
    """
    rows = bands.select("node", F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("_last"))
    shared = buckets.where("leader != _last").select("bucket", "leader")
    star = stored(spark, rows.join(shared, "bucket").select("leader", "node").distinct(), "star")

    sized = star.join(texts.select("node", "copies", "size"), "node")
    large = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    blocks = sized.groupBy("leader").agg(large.cast("int").alias("blocks")).where("blocks > 1")
    placed = star.join(blocks, "leader", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = placed.groupBy("node").agg(F.collect_list(F.struct("leader", "blocks")).alias("groups"))
    weights = texts.select("node", "copies")
    needed = mine.join(weights, "node").join(sets_of(star.select("node").distinct()), "node")
    exploded = needed.select("*", F.explode("groups").alias("g"), F.col("groups.leader").alias("leaders"))
    own = F.pmod(F.xxhash64("node"), F.col("g.blocks")).cast("int")
    dealt = exploded.select("node", "copies", "shingles", "leaders", "g.leader", own.alias("block"), F.explode(F.sequence(F.lit(0), F.col("g.blocks") - 1)).alias("other"))
    pairs = dealt.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other")).drop("other")
    keys = ("leader", "first", "second")
    sorted_pairs = pairs.repartition(*keys).sortWithinPartitions(*keys)
    found = sorted_pairs.mapInArrow(_verify_task(Fraction(similarity)), "node bigint, texts bigint, rows bigint, root bigint")
    found = stored(spark, found, "links")

    sums = found.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("rows").alias("rows"))
    roots = components(spark, found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return sums.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
