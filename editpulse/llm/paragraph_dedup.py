"""Repeated passages: near-duplicate paragraphs within and across documents, all but one occurrence removed."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm import minhash
from editpulse.llm.batches import Words, flat, slices, spread, texts_of, words
from editpulse.llm.tables import stored

SIMILARITY, RECALL, ROWS = "0.8", 0.99, 1
BANDS = minhash.bands_for(float(SIMILARITY), RECALL, ROWS)
MIN_WORDS = 8
# With ``whole``, runs without natural ends are cut into pieces of so many words to one less than twice as many.
SPACING = 12
# Unpunctuated text is cut after one word in so many, chosen by the word's hash alone.
_CUT_ONE_IN = np.uint64(64)
_SENTENCE_END = r"[.!?][\"')\]]*$"


def _least_before(x: np.ndarray, reach: int) -> np.ndarray:
    """The least of the ``reach`` values before each place."""
    most = np.uint64(2**64 - 1)
    out, width = np.concatenate(([most], x[:-1])), 1
    while width < reach:
        step = min(width, reach - width)
        out[step:] = np.minimum(out[step:], out[:-step].copy())
        width += step
    return out


def _least_near(places: np.ndarray, x: np.ndarray, least: int, size: int) -> np.ndarray:
    """Whether each place's value is the least, and of equal ones the first, of those less than ``least`` away."""
    most = np.uint64(2**64 - 1)
    if 2 * len(places) > size:
        full = np.full(size, most)
        full[places] = x
        return (x < _least_before(full, least - 1)[places]) & (x <= _least_before(full[::-1], least - 1)[::-1][places])
    found = x < most
    for step in range(1, least):
        near = places[step:] - places[:-step] < least
        if not near.any():
            break
        smaller = x[step:] < x[:-step]
        found[step:] &= ~near | smaller
        found[:-step] &= ~near | ~smaller
    return found


def _spaced_cuts(chosen: np.ndarray, wanted: np.ndarray, ranks: np.ndarray, least: int) -> np.ndarray:
    """``chosen`` and as many of the ``wanted`` places as fit with ``least`` words between any two, smallest rank first.

    Whether a place is taken depends only on the ranks of those near it, so a copy is cut like its original
    but for its ends. Words that repeat for long give no sign; there cuts follow each other from the left.
    Each round looks at the places that are still free alone.
    """
    out, new = chosen.copy(), np.flatnonzero(chosen)
    free = np.flatnonzero(wanted)
    free = free[free >= least - 1]
    for _ in range(24):
        ends = np.concatenate(([-least], new, [len(out) + least]))
        after = np.searchsorted(new, free) + 1
        free = free[(free - ends[after - 1] >= least) & (ends[after] - free >= least)]
        if not len(free):
            break
        new = free[_least_near(free, ranks[free], least, len(out))]
        out[new] = True
    else:
        last = -least
        for place in free:
            if place - last >= least:
                out[place] = True
                last = place
    return out


def _paragraphs(texts: pa.Array, whole: bool = False) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words, their hashes, first word of each paragraph and the end, paragraphs before each text)."""
    lines, line_ends = flat(pc.split_pattern(texts, "\n"))
    split = words(lines)
    hashes = minhash.word_hashes(split)
    ends = pc.match_substring_regex(split.vocabulary, _SENTENCE_END).to_numpy(zero_copy_only=False)[split.codes]
    of_text = split.offsets[line_ends]
    line_last = split.offsets[1:][np.diff(split.offsets) > 0] - 1
    if whole and len(hashes):
        ends[line_last] = True
        last = np.zeros(len(hashes), bool)
        last[of_text[1:][np.diff(of_text) > 0] - 1] = True
        ranks = minhash.mixed(hashes ^ minhash.mixed(np.concatenate(([np.uint64(0)], hashes[:-1]))))
        cut = _spaced_cuts(last, ends, ranks, MIN_WORDS)
        cut = _spaced_cuts(cut, np.ones(len(hashes), bool), ranks, SPACING)
    else:
        cut = ends | (hashes % _CUT_ONE_IN == 0)
        cut[line_last] = True
    bounds = np.concatenate(([0], np.flatnonzero(cut) + 1))
    return split, hashes, bounds, np.searchsorted(bounds, of_text)


def _nodes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each paragraph's word sequence."""
    if len(bounds) < 2:
        return np.zeros(0, np.uint64)
    place = (np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64)
    return minhash.mixed(np.add.reduceat(minhash.mixed(hashes ^ minhash.mixed(place)), bounds[:-1]))


def _plain(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("doc"), "text")


def paragraphs(docs: DataFrame, whole: bool = False) -> DataFrame:
    """Every paragraph of at least 8 words: doc_id, doc (hash of id and text), at (its number there), words, node, bands."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, hashes, bounds, before = _paragraphs(texts_of(batch, "text"), whole)
            count = np.diff(bounds)
            chosen = np.flatnonzero(count >= MIN_WORDS)
            owner = np.searchsorted(before, chosen, side="right") - 1
            values, ends = minhash.shingle_hashes(hashes, bounds)
            least = [np.minimum.reduceat(minhash.mixed(values ^ np.uint64(k << 32)), ends[:-1]) for k in range(1, BANDS + 1)] if len(count) else []
            bands = np.stack([minhash.mixed(x[chosen] + np.uint64(k)) for k, x in enumerate(least)], axis=1) if len(count) else np.zeros((0, BANDS), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    batch.column("doc").take(pa.array(owner)),
                    pa.array((chosen - before[owner]).astype(np.int32)),
                    pa.array(count[chosen].astype(np.int32)),
                    pa.array(_nodes(hashes, bounds)[chosen].view(np.int64)),
                    minhash.list_array(bands.ravel(), np.arange(len(chosen) + 1) * BANDS),
                ],
                names=["doc_id", "doc", "at", "words", "node", "bands"],
            )

    return _plain(docs).mapInArrow(rows, "doc_id bigint, doc bigint, at int, words int, node bigint, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, whole: bool) -> DataFrame:
    """(node, shingles) of the paragraphs at the wanted (doc, at), from the texts of those documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, hashes, bounds, before = _paragraphs(texts_of(batch, "text"), whole)
            at, of_text = flat(batch.column("places"))
            each = np.diff(of_text)
            chosen = np.repeat(before[:-1], each) + at.to_numpy()
            chosen = chosen[chosen < np.repeat(before[1:], each)]
            count = np.diff(bounds)[chosen]
            own, ends = hashes[spread(bounds[chosen], count)], np.concatenate(([0], np.cumsum(count)))
            sets = minhash.list_array(*minhash.distinct_sets(*minhash.shingle_hashes(own, ends)))
            yield pa.RecordBatch.from_arrays([pa.array(_nodes(own, ends).view(np.int64)), sets], names=["node", "shingles"])

    places = wanted.groupBy("doc").agg(F.collect_list("at").alias("places"))
    found = _plain(docs).select("doc", "text").join(places, "doc").select("text", "places").mapInArrow(rows, "node bigint, shingles array<bigint>")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def repeated_paragraphs(spark: SparkSession, docs: DataFrame, whole: bool = False) -> DataFrame:
    """Occurrences to remove: doc_id, doc, at, words, cluster, kept_doc_id.

    A paragraph ends at a line break, at a sentence end, and in long unpunctuated runs after words whose
    hash says so: all local signs, so a passage pasted into other text is cut like its original but for
    its two ends. Paragraphs of at least 8 words count, so words in shorter ones are never compared. With
    ``whole`` there are none shorter but texts of fewer than 8 words: natural ends closer than that are joined
    into one paragraph, and runs without one are cut after every 12 to 23 words, both by local hashes. Two are near-duplicates if the Jaccard
    similarity of their word 5-grams is 0.8 or more, and clusters are the components; of each cluster the
    occurrence in the smallest doc_id (nulls first), then hash of the document, then place, is kept.

    Three bands of one MinHash each make a pair at 0.8 meet with probability 0.99; what meets is verified on
    full sets. Equal paragraphs are one node, so copies are never compared. Occurrences of a hot paragraph
    are only counted and joined, not gathered. Null, empty and wordless texts have no paragraphs; repeated
    rows (same id and text) are one document; other columns are not read.
    """
    found = stored(spark, paragraphs(docs, whole), "paragraphs")
    counts = found.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), (F.max("words") - (minhash.SHINGLE - 1)).cast("bigint").alias("size"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        one = found.select("node", "doc", "at").join(nodes, "node").groupBy("node").agg(F.min(F.struct("doc", "at")).alias("place"))
        return _sets(docs, one.select("place.doc", "place.at"), whole)

    links = stored(spark, minhash.linked_texts(spark, found.select("node", "bands"), counts, sets_of, SIMILARITY).select("node", "root"), "roots")
    again = counts.where("copies > 1").select("node").join(links, "node", "full_outer")
    clusters = again.select("node", F.coalesce("root", "node").alias("cluster"))
    places = stored(spark, found.drop("bands").join(clusters, "node").drop("node").distinct(), "places")
    first = places.groupBy("cluster").agg(F.min(F.struct("doc_id", "doc", "at")).alias("kept"))
    marked = places.join(first, "cluster").where((F.col("doc") != F.col("kept.doc")) | (F.col("at") != F.col("kept.at")))
    return marked.select("doc_id", "doc", "at", "words", "cluster", F.col("kept.doc_id").alias("kept_doc_id"))


def without_paragraphs(docs: DataFrame, removed: DataFrame, whole: bool = False) -> DataFrame:
    """``docs`` with the removed paragraphs (found with the same ``whole``) cut out of their texts; the rest of a text stays
    as it is, white space included."""
    listed = removed.groupBy("doc").agg(F.sort_array(F.collect_list("at")).alias("_cut"))
    names = docs.columns
    keyed = docs.withColumn("_doc", F.xxhash64(F.col("doc_id").cast("bigint"), "text"))
    joined = keyed.join(listed, F.col("_doc") == F.col("doc"), "left").select(F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("_rest"), F.col("text").alias("_text"), "_cut")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            texts, cuts = batch.column("_text").to_pylist(), batch.column("_cut").to_pylist()
            out = [t if not cut else _cut_out(t, set(cut), whole) for t, cut in zip(texts, cuts)]
            yield pa.RecordBatch.from_arrays([batch.column("_rest"), pa.array(out, pa.string())], names=["_rest", "_text"])

    kind = joined.select("_rest", "_text").schema
    cleaned = joined.mapInArrow(rows, kind)
    return cleaned.select(*[F.col("_text").alias("text") if c == "text" else F.col(f"_rest.`{c}`").alias(c) for c in names])


def _cut_out(text: str, numbers: set[int], whole: bool) -> str:
    """The text without its paragraphs of these numbers."""
    _, _, bounds, _ = _paragraphs(pa.array([text], pa.large_string()), whole)
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out, at = [], 0
    for number in sorted(numbers):
        first, last = spans[bounds[number]][0], spans[bounds[number + 1] - 1][1]
        out.append(text[at:first])
        at = last
    return "".join([*out, text[at:]])
