"""Ranked lexical search: item bundles gather document scores from one term owner after another."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editpulse.llm.batches import slices, spread, texts_of, words
from editpulse.llm.tables import stored

# A lane is a run of documents whose scores are gathered together: at most so many documents and postings of wanted terms.
LANE_DOCUMENTS, LANE_POSTINGS = 8192, 1 << 20
# Items of one bundle.
BUNDLE_ITEMS = 256
# Terms of a weight from the first bound on belong to the first owner, those from the second on to the next, and so on.
OWNERS = (4000, 2500, 1500, 1)
# A term's share of a score is below its weight times this.
_MOST = 1_000_000
# Wanted terms are first sought in a bitmap of fixed size; the join on their hashes decides.
_FILTER_BITS = 1 << 24

_DOCUMENTS = "lane bigint, slot int, doc_id bigint, n bigint, terms array<bigint>, times array<int>"
_TERM = "item_id bigint, term bigint, times bigint"
_SPEC = "spec array<struct<item:int,term:bigint,owner:int,gain:bigint>>"
_BUNDLE = f"lane bigint, bundle int, {_SPEC}, floors array<bigint>, items array<int>, slots array<int>, scores array<bigint>"

# Bytes outside terms become spaces and A to Z lower case; bytes of longer characters stay.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
for _first, _last, _shift in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0)):
    _FOLD[_first : _last + 1] = np.arange(_first, _last + 1) + _shift


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(each term's place in the batch's vocabulary, offsets by text, hashes of the vocabulary)"""
    _, ends, data = texts.buffers()
    folded = _FOLD[np.frombuffer(data or b"", np.uint8)]
    split = words(pa.LargeStringArray.from_buffers(len(texts), ends, pa.py_buffer(folded)) if len(texts) else texts)
    of = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((of(w) for w in split.vocabulary.to_pylist()), np.uint64, len(split.vocabulary))
    return split.codes, split.offsets, hashes.view(np.int64)


def _counted(owner: np.ndarray, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of each distinct term of each text, by text"""
    found, times = np.unique(owner * max(1, width) + codes, return_counts=True)
    return found // max(1, width), found % max(1, width), times


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of all items; rows with one item_id are one item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes, offsets, hashes = _terms(texts_of(batch, "text"))
            owner, term, times = _counted(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)), codes, len(hashes))
            columns = [batch.column("item_id").take(pa.array(owner)), pa.array(hashes[term]), pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "term", "times"])

    each = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(rows, _TERM)
    return each.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def _bitmap(terms: DataFrame) -> np.ndarray:
    """The wanted terms' places in a bitmap; what comes to the driver is bounded by the bitmap's size."""
    places = terms.select(F.pmod("term", F.lit(_FILTER_BITS)).cast("int").alias("place")).distinct().toPandas()["place"]
    bits = np.zeros(_FILTER_BITS, bool)
    bits[places.to_numpy()] = True
    return np.packbits(bits)


def indexed(spark: SparkSession, docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The documents by lane: their length in terms, and their wanted terms with occurrences.

    Slots of a lane follow the doc_ids (nulls first), so that ties go to the smaller slot.
    """
    wanted = spark.sparkContext.broadcast(_bitmap(terms))
    most_documents, most_postings = LANE_DOCUMENTS, LANE_POSTINGS

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId() << 32
        bits = np.unpackbits(wanted.value).astype(bool)
        held: list[pa.RecordBatch] = []
        documents = postings = 0

        def emit() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            whole = whole.take(pc.sort_indices(whole, sort_keys=[("doc_id", "ascending")], null_placement="at_start"))
            n = whole.num_rows
            own = pa.table({"lane": pa.array(np.full(n, lane)), "slot": pa.array(np.arange(n, dtype=np.int32))})
            for name in ("doc_id", "n", "terms", "times"):
                own = own.append_column(name, whole[name])
            return own.combine_chunks().to_batches()[0]

        for batch in slices(batches, "text"):
            codes, offsets, hashes = _terms(texts_of(batch, "text"))
            hit = bits[hashes & (_FILTER_BITS - 1)][codes]
            owner, term, times = _counted(np.repeat(np.arange(batch.num_rows), np.diff(offsets))[hit], codes[hit], len(hashes))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            length = np.diff(offsets)
            start = 0
            while start < batch.num_rows:
                room = int(np.searchsorted(ends, ends[start] + most_postings - postings, side="right")) - 1
                stop = min(max(start + (not held), room), start + most_documents - documents, batch.num_rows)
                if stop > start:
                    a, b = ends[start], ends[stop]
                    bounds = pa.array((ends[start : stop + 1] - a).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (hashes[term[a:b]], times[a:b].astype(np.int32))]
                    columns = [batch.column("doc_id").slice(start, stop - start), pa.array(length[start:stop]), *lists]
                    held.append(pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"]))
                    documents, postings, start = documents + stop - start, postings + int(b - a), stop
                if start < batch.num_rows:
                    yield emit()
                    held, documents, postings, lane = [], 0, 0, lane + 1
        if held:
            yield emit()

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(spark, plain.mapInArrow(rows, _DOCUMENTS), "documents-by-lane")


def _add(owner: int, k: int):
    """One owner's work on one bundle in one lane: its postings added to the bundle's scores."""

    def add(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundles.num_rows:
            return bundles
        bundle = bundles.slice(0, 1).combine_chunks()
        spec = bundle["spec"].combine_chunks().flatten()
        of = {name: spec.field(name).to_numpy() for name in ("item", "term", "owner", "gain")}
        count = int(of["item"].max()) + 1
        floors = bundle["floors"].combine_chunks().flatten().to_numpy().copy()
        if not len(floors):
            floors = np.zeros(count, np.int64)
        item, slot, score = (bundle[c].combine_chunks().flatten().to_numpy() for c in ("items", "slots", "scores"))
        ahead = [np.bincount(of["item"][of["owner"] >= o], weights=of["gain"][of["owner"] >= o], minlength=count).astype(np.int64) * _MOST for o in (owner, owner + 1)]

        # Scores are dense while they are added to: at most a bundle's items times a lane's documents.
        seen_slots = postings["slot"].to_numpy()
        width = int(max(slot.max(initial=-1), seen_slots.max(initial=-1))) + 1
        total = np.zeros((count, width), np.int64)
        total[item, slot] = score
        order = np.argsort(postings["term"].to_numpy(), kind="stable")
        terms, slots, shares = (postings[c].to_numpy()[order] for c in ("term", "slot", "share"))
        mine = np.flatnonzero(of["owner"] == owner)
        first, last = (np.searchsorted(terms, of["term"][mine], side=side) for side in ("left", "right"))
        # What new documents could still reach is below the k-th best already: only known ones go on.
        closed = ahead[0] < floors
        for e, a, b in zip(mine, first, last):
            row, at, gain = total[of["item"][e]], slots[a:b], of["gain"][e]
            if closed[of["item"][e]]:
                known = row[at] > 0
                row[at[known]] += gain * shares[a:b][known]
            else:
                row[at] += gain * shares[a:b]
        for i in range(count):
            row = total[i]
            if np.count_nonzero(row) >= k:
                floors[i] = max(floors[i], np.partition(row, width - k)[width - k])
            row[row + ahead[1][i] < floors[i]] = 0
        item, slot = np.nonzero(total)
        lists = {
            "spec": pa.StructArray.from_arrays([pa.array(of[c]) for c in of], names=list(of)),
            "floors": pa.array(floors),
            "items": pa.array(item.astype(np.int32)),
            "slots": pa.array(slot.astype(np.int32)),
            "scores": pa.array(total[item, slot]),
        }
        one_row = {c: pa.ListArray.from_arrays(np.array([0, len(x)], np.int32), x) for c, x in lists.items()}
        return pa.table({"lane": bundle["lane"], "bundle": bundle["bundle"], **one_row})

    return add


def _best(k: int):
    """(bundle, item, lane, slot, score) of the ``k`` best of each item in each lane."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                item, slot, score = (batch.column(c).slice(r, 1).flatten().to_numpy() for c in ("items", "slots", "scores"))
                order = np.lexsort((slot, -score, item))
                starts = np.searchsorted(item[order], np.unique(item))
                place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
                order = order[place < k]
                same = [pa.array(np.full(len(order), batch.column(c)[r].as_py(), t)) for c, t in (("bundle", np.int32), ("lane", np.int64))]
                columns = [*same, pa.array(item[order]), pa.array(slot[order]), pa.array(score[order])]
                yield pa.RecordBatch.from_arrays(columns, names=["bundle", "lane", "item", "slot", "score"])

    return rows


def lexical_search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score; documents of score 0 are left out.

    Terms are runs of digits, ASCII letters (lower-cased) and all characters beyond ASCII. With N documents that have a
    term and L terms in all, a term in df documents weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), and a document
    of n terms with tf of it gains w * ((1000000000 * tf) div (1000 * tf + 12 * (75 + (25 * n * N) div L))), once for each
    occurrence in the item. N, L and df count all documents.

    Terms have one of four owners, by weight. Documents lie in lanes of at most 8192; a bundle of up to 256
    items visits each lane and is cogrouped there with the postings of the first owner, then of the next,
    heaviest terms first. It carries the scores of the documents met so far, adds the owner's integer
    contributions and lets go of documents that cannot reach the k-th best score of the lane even with all that later
    owners may give; the result is exact. The best of each lane then compete.

    Rows with one item_id (null is one too) are one item; items without a term have no row. Equal scores
    go by doc_id, nulls first, then by place in the input; repeated rows of documents are documents of their own. Null
    and empty texts have no terms. Terms are known by 64-bit hashes. Other columns are not read.
    """
    wanted = stored(spark, item_terms(items), "item-terms")
    numbered = wanted.select("item_id").distinct()
    bundles = max(1, -(-numbered.count() // BUNDLE_ITEMS))
    bundle = F.pmod(F.xxhash64("item_id"), F.lit(bundles)).cast("int")
    places = Window.partitionBy("bundle").orderBy("item_id")
    numbered = stored(spark, numbered.withColumn("bundle", bundle).withColumn("item", F.row_number().over(places) - 1), "items")

    index = indexed(spark, docs, wanted)
    count, length = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = index.select("lane", "slot", "n", F.explode(F.arrays_zip("terms", "times")).alias("t"))
    held = held.select("lane", "slot", "n", "t.terms", "t.times").withColumnRenamed("terms", "term")
    df = held.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(wanted.select("term").distinct(), "term")
    weight = F.floor(1000 * F.log((2.0 * F.lit(count) + 2) / (2 * F.col("df") + 1))).cast("bigint")
    owner = F.lit(len(OWNERS) - 1)
    for number in reversed(range(len(OWNERS) - 1)):
        owner = F.when(F.col("weight") >= OWNERS[number], number).otherwise(owner)
    weights = stored(spark, df.select("term", weight.alias("weight")).where("weight > 0").withColumn("owner", owner.cast("int")), "weights")

    same_item = F.col("i.item_id").eqNullSafe(F.col("q.item_id"))
    known = wanted.alias("q").join(numbered.alias("i"), same_item).select("i.bundle", "i.item", "q.term", "q.times").join(weights, "term")
    known = stored(spark, known.select("bundle", F.struct("item", "term", "owner", (F.col("times") * F.col("weight")).alias("gain")).alias("e")), "specs")
    specs = known.groupBy("bundle").agg(F.sort_array(F.collect_list("e")).alias("spec"))
    lanes = index.select("lane").distinct().select("lane", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"))
    none = [F.array().cast(f"array<{t}>").alias(c) for c, t in (("floors", "bigint"), ("items", "int"), ("slots", "int"), ("scores", "bigint"))]
    travelling = lanes.join(specs, "bundle").select("lane", "bundle", "spec", *none)

    owned = known.select("bundle", "e.term", "e.owner").distinct()
    norm = F.lit(75) + F.expr(f"(25 * n * {count}L) div {max(1, length)}L")
    share = F.expr("(1000000000L * times) div (1000L * times + 12L * _norm)")
    postings = held.withColumn("_norm", norm).join(owned, "term").select("lane", "bundle", "owner", "term", "slot", share.alias("share"))
    postings = stored(spark, postings.sortWithinPartitions("owner"), "postings")
    for number in range(len(OWNERS)):
        own = postings.where(F.col("owner") == number).drop("owner")
        visit = travelling.groupBy("lane", "bundle").cogroup(own.groupBy("lane", "bundle"))
        travelling = visit.applyInArrow(_add(number, k), _BUNDLE)

    best = travelling.select("lane", "bundle", "items", "slots", "scores").mapInArrow(_best(k), "bundle int, lane bigint, item int, slot int, score bigint")
    named = best.join(index.select("lane", "slot", "doc_id"), ["lane", "slot"])
    order = Window.partitionBy("bundle", "item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "lane", "slot")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(numbered, ["bundle", "item"]).select("item_id", "rank", "doc_id", "score")
