"""Benchmark decontamination: q-gram counting in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.batches import slices, texts_of

Q = 12
EDIT_SHARE = 0.05
# Benchmark text that one pass over the documents looks for; a longer benchmark takes more passes.
BLOCK_CHARS = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32


def normal(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, lower case, each run of white space one space, none at the ends; and offsets."""
    joined = "\x00".join(texts) + "\x00"
    lowered = joined.lower()
    code = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (code == _SPACE) | ((code >= 9) & (code <= 13))
    ends = np.flatnonzero(code == 0)
    if len(ends) != len(texts):  # a text has U+0000 of its own
        parts = [np.frombuffer(t.replace("\x00", " ").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        code = np.concatenate([np.append(p, np.uint32(0)) for p in parts])
        blank = (code == _SPACE) | ((code >= 9) & (code <= 13))
        ends = np.flatnonzero(code == 0)
    edge = np.ones(len(code), bool)
    edge[1:] = blank[:-1] | (code[:-1] == 0)
    keep = ~(blank & edge)
    last = ends[ends > 0] - 1
    keep[last[blank[last]]] = False
    kept = np.where(blank, np.uint32(_SPACE), code)[keep]
    # A blank before a dropped final blank cannot be: runs keep their first one, which may be the final one.
    ends = np.flatnonzero(kept == 0)
    trailing = ends[ends > 0] - 1
    trailing = trailing[kept[trailing] == _SPACE]
    if len(trailing):
        kept = np.delete(kept, trailing)
        ends = np.flatnonzero(kept == 0)
    return kept, np.concatenate(([0], ends + 1))


def grams(code: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q code points from each position on (by doubling: 1, 2, 4, 8, then 12)."""
    one = code.astype(np.uint64) + np.uint64(1)
    two = one[:-1] * _BASE + one[1:]
    square = (one[:1] * 0 + _BASE) * _BASE  # arrays wrap around silently
    four = two[:-2] * square + two[2:]
    power = square * square
    eight = four[:-4] * power + four[4:]
    return eight[:-4] * power + four[8:]


class Block(NamedTuple):
    """Benchmark items of one pass and the index of their q-grams."""

    ids: np.ndarray
    code: np.ndarray
    offsets: np.ndarray
    budget: np.ndarray
    needed: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray

    def text(self, item: int) -> np.ndarray:
        return self.code[self.offsets[item] : self.offsets[item + 1] - 1]


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(42)).astype(np.int64)


def block_of(ids: list[int | None], texts: list[str]) -> Block:
    """The index of some items. An item of m characters may differ by e = 5 % of m edits, but by so few only
    that the q-gram lemma leaves at least one of its m - Q + 1 q-grams: a region within e edits shares
    m - Q + 1 - e * Q of them. Items shorter than Q are sought as they are."""
    code, offsets = normal(texts)
    length = np.diff(offsets) - 1
    budget = np.minimum((EDIT_SHARE * length).astype(np.int64), np.maximum(0, (length - Q) // Q))
    counts = np.maximum(0, length - Q + 1)
    item = np.repeat(np.arange(len(ids)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    all_grams = grams(code) if len(code) >= Q else np.zeros(0, np.uint64)
    value = all_grams[offsets[item] + place] if len(item) else all_grams[:0]
    order = np.argsort(value, kind="stable")
    hashes, first = np.unique(value[order], return_index=True)
    seen = np.zeros(1 << 22, bool)
    seen[_slot(hashes)] = True
    return Block(
        np.array([-1 if i is None else i for i in ids], np.int64), code, offsets, budget, counts - budget * Q, hashes,
        np.append(first, len(value)), item[order], place[order], seen,
    )


def exact(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int, int] | None:
    """(0, start, end) of the first equal substring, which needs no alignment."""
    raw, wanted = text.tobytes(), pattern.tobytes()
    at = raw.find(wanted)
    while at >= 0 and at % 4:
        at = raw.find(wanted, at + 1)
    return (0, at // 4, at // 4 + len(pattern)) if at >= 0 else None


def aligned(pattern: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the substring of ``text`` nearest to ``pattern``, or None beyond ``most`` edits.

    Only a band of diagonals is filled: with ``most`` edits no path leaves those from -most to that many beyond the
    ones on which the pattern's end meets the text's. Of equal distances the earliest end counts.
    """
    m, n = len(pattern), len(text)
    low, high = -most, n - m + most
    width = high - low + 1
    if width <= 0:
        return None
    diagonal = np.arange(low, high + 1)
    big = np.int64(1 << 32)
    far = (m + n + 1) * big
    steps = np.arange(width) * big
    # Cost and start as one number, so that equal costs take the earliest start.
    key = np.where((diagonal >= 0) & (diagonal <= n), diagonal, far)
    padded = np.zeros(n + 2 * (m + width), np.uint32)
    padded[m + width : m + width + n] = text
    for k, char in enumerate(pattern):
        at = m + width + k + low
        across = key + np.where(padded[at : at + width] != char, big, 0)
        across[:-1] = np.minimum(across[:-1], key[1:] + big)
        # Before the text's begin and behind its end there is nothing.
        across[: max(0, -low - k - 1)] = far
        across[max(0, n - k - low) :] = far
        key = np.minimum.accumulate(across - steps) + steps
        if key.min() >= (most + 1) * big:
            return None
    key[max(0, n - m - low + 1) :] = far
    end = int(np.argmin(key >> 32))
    return (int(key[end] >> 32), int(key[end] & (big - 1)), end + low + m) if key[end] >> 32 <= most else None


def _regions(block: Block, code: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first, last): stretches with as many shared q-grams in one band as the lemma asks for."""
    if len(code) < Q or not len(block.hashes):
        return
    value = grams(code)
    maybe = np.flatnonzero(block.seen[_slot(value)])
    at = np.searchsorted(block.hashes, value[maybe])
    at[at == len(block.hashes)] = 0
    hit = block.hashes[at] == value[maybe]
    spots, at = maybe[hit], at[hit]
    if not len(spots):
        return
    text = np.searchsorted(offsets, spots, side="right") - 1
    counts = np.diff(block.first)[at]
    entry = np.repeat(block.first[at] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    item, place = block.item[entry], block.place[entry]
    text, spot = np.repeat(text, counts), np.repeat(spots, counts)
    diagonal = spot - offsets[text] - place
    # Bands are two steps of (edits + 1) diagonals wide and overlap by one, so a region fits into one whole.
    step = block.budget[item] + 1
    band = np.floor_divide(diagonal, step)
    rows = [np.concatenate([x, x]) for x in (text, item)] + [np.concatenate([band, band - 1])]
    order = np.lexsort(rows[::-1])
    t, i, b = (x[order] for x in rows)
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1])
    starts = np.flatnonzero(new)
    shared = np.diff(np.append(starts, len(t)))
    good = starts[shared >= np.maximum(1, block.needed[i[starts]])]
    for k in good:
        low = b[k] * (block.budget[i[k]] + 1)
        edits = block.budget[i[k]]
        # Diagonals low to low + 2 * step, and the edits to either side.
        yield int(t[k]), int(i[k]), int(low - edits), int(low + 2 * (edits + 1) + edits + (block.offsets[i[k] + 1] - block.offsets[i[k]] - 1))


def find(block: Block, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of the nearest occurrence of each item in each text that has one."""
    code, offsets = normal(texts)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, item, first, last in _regions(block, code, offsets):
        if best.get((text, item), (1,))[0] == 0:
            continue
        own = code[offsets[text] : offsets[text + 1] - 1]
        low = max(0, first)
        region, wanted = own[low : max(low, last)], block.text(item)
        found = exact(wanted, region) or aligned(wanted, region, int(block.budget[item]))
        if found:
            new = (found[0], low + found[1], low + found[2])
            best[text, item] = min(best.get((text, item), new), new)
    short = [k for k in range(len(block.ids)) if 0 < block.offsets[k + 1] - block.offsets[k] - 1 < Q]
    if short:
        plain = code.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        for item in short:
            wanted = block.text(item).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            at = plain.find(wanted)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right") - 1)
                best.setdefault((text, item), (0, int(at - offsets[text]), int(at - offsets[text]) + len(wanted)))
                at = plain.find(wanted, int(offsets[text + 1]))
    return [(text, item, start, end, edits) for (text, item), (edits, start, end) in sorted(best.items())]


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of the benchmark, a bounded block at a time."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("bigint"), "text").where("text is not null").distinct().toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1])
        if size >= BLOCK_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


MATCH = "doc_id bigint, tie bigint, item_id bigint, start int, end int, edits int"


def contaminations(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items found in documents: doc_id, tie (hash of the text), item_id, start, end, edits.

    Texts are compared in lower case with white space runs as one space; start and end are characters
    there. An item counts as found if some stretch of the whole document is within 5 % of its
    length in edits (insertions, deletions, replacements); the nearest stretch is returned, one row for
    each row of ``docs`` and item.

    The benchmark comes to the tasks in blocks of about 4 million characters, one pass over the documents
    per block, without a shuffle. Null and empty texts match nothing, on either side. Items shorter than 12
    characters must occur as they are. Repeated benchmark rows count once; null item ids become -1.
    Repeated documents give repeated rows. Other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    found = None
    for ids, texts in _blocks(benchmark):

        def rows(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts) -> Iterator[pa.RecordBatch]:
            block = block_of(ids, texts)
            for batch in slices(batches, "text", 1 << 20):
                matches = find(block, texts_of(batch, "text").to_pylist())
                text, item, start, end, edits = (np.array(x, np.int64) for x in zip(*matches)) if matches else [np.zeros(0, np.int64)] * 5
                owner = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(owner),
                        batch.column("tie").take(owner),
                        pa.array(block.ids[item]),
                        *[pa.array(x.astype(np.int32)) for x in (start, end, edits)],
                    ],
                    names=["doc_id", "tie", "item_id", "start", "end", "edits"],
                )

        one = plain.mapInArrow(rows, MATCH)
        found = one if found is None else found.unionByName(one)
    return spark.createDataFrame([], MATCH) if found is None else found


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which a benchmark item was found."""
    key = F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit(""))
    hit = contaminations(spark, docs, benchmark).select(key.alias("_id"), F.col("tie").alias("_tie")).distinct()
    names = docs.columns
    keyed = docs.withColumns({"_id": key, "_tie": F.xxhash64("text")})
    return keyed.join(hit, ["_id", "_tie"], "left_anti").select(*[F.col(f"`{c}`") for c in names])
