"""Training sequences of related documents: BM25 neighbours of a seed fill its window."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.batches import give_back, slices, spread, texts_of
from editpulse.llm.tables import stored
from editpulse.llm.tokenizing import encoder, with_end

WINDOW = 4096
# Tokens of one index shard: consecutive documents of one stored partition.
SHARD_TOKENS = 1 << 19
K1, B = 1.2, 0.75
_TOKENS = "doc_id bigint, kind int, n bigint, ids array<int>, counts array<int>"
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _terms(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token, times) of each distinct token of each document, by document."""
    width = int(ids.max(initial=0)) + 1
    # Narrow keys where they fit: sorting them is most of the work.
    kind = np.uint32 if (len(offsets) - 1) * width < 1 << 32 else np.int64
    key = np.repeat(np.arange(len(offsets) - 1, dtype=kind), np.diff(offsets)) * kind(width) + ids.astype(kind)
    found, times = np.unique(key, return_counts=True)
    return (found // kind(width)).astype(np.int64), (found % kind(width)).astype(np.int64), times


def _holders(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the documents hold each token, by token; in place as far as it goes, since this runs beside the encoder's words."""
    width = int(ids.max(initial=0)) + 1
    kind = np.uint32 if (len(offsets) - 1) * width < 1 << 32 else np.int64
    key = np.repeat(np.arange(len(offsets) - 1, dtype=kind) * kind(width), np.diff(offsets))
    key += ids.astype(kind)
    key.sort()
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    key = key[first]
    key %= kind(width)
    return np.bincount(key, minlength=width)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Rows of kind 0: a document's ids. Of kind 1, one per task: the tokens it saw and the documents with each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        count = total = 0

        def out(doc_id: pa.Array, kind: int, n: np.ndarray, ids: pa.Array, counts: pa.Array) -> pa.RecordBatch:
            kinds = pa.array(np.full(len(n), kind, np.int32))
            return pa.RecordBatch.from_arrays([doc_id, kinds, pa.array(n, pa.int64()), ids, counts], names=["doc_id", "kind", "n", "ids", "counts"])

        for batch in slices(batches, "text"):
            ids, offsets = with_end(*encoder(tokenizer)(texts_of(batch, "text")), end_id)
            more = _holders(ids, offsets)
            small, seen = sorted((seen, more), key=len)
            seen[: len(small)] += small
            count, total = count + batch.num_rows, total + len(ids)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
            yield out(batch.column("doc_id"), 0, np.diff(offsets), lists, pa.nulls(batch.num_rows, pa.list_(pa.int32())))
        if count:
            used = np.flatnonzero(seen)
            bounds = pa.array([0, len(used)], pa.int32())
            each = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (used, seen[used])]
            yield out(pa.array([total], pa.int64()), 1, np.array([count]), *each)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(rows, _TOKENS)


class Statistics:
    """Documents with each token, documents and mean length, over the whole corpus."""

    def __init__(self, tokens: np.ndarray, documents: np.ndarray, count: int, total: int):
        self.idf = np.full(int(tokens.max(initial=0)) + 1, np.log(1 + (count + 0.5) / 0.5), np.float32)
        self.idf[tokens] = np.log(1 + (count - documents + 0.5) / (documents + 0.5))
        self.mean = total / max(1, count)


def statistics(tokens: DataFrame) -> Statistics:
    """Summed by Spark; what comes to the driver is one row per token of the vocabulary at most."""
    summed = tokens.where("kind = 1")
    count, total = summed.agg(F.sum("n"), F.sum("doc_id")).first()
    each = summed.select(F.explode(F.arrays_zip("ids", "counts")).alias("t")).groupBy("t.ids").agg(F.sum("t.counts").alias("documents"))
    found = each.toPandas()
    return Statistics(found["ids"].to_numpy(np.int64), found["documents"].to_numpy(np.int64), count or 0, total or 0)


class Shard:
    """A BM25 inverted index over some documents: postings by token, with each posting's score."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, known: Statistics):
        doc, token, times = _terms(ids, offsets)
        length = np.diff(offsets)
        norm = K1 * (1 - B + B * length / max(1.0, known.mean))
        score = known.idf[token] * (times * (K1 + 1)) / (times + norm[doc])
        self.count = len(length)
        self.token, self.firsts = token, np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=self.count))))
        order = np.argsort(token.astype(np.uint16) if token.max(initial=0) < 1 << 16 else token, kind="stable")
        self.doc, self.score = doc[order].astype(np.int32), score[order]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(token, minlength=int(token.max(initial=0)) + 1))))

    def neighbours(self, doc: int, unused: np.ndarray) -> np.ndarray:
        """The unused documents by BM25 for the seed's tokens, best first, equal scores in document order; then those without one."""
        tokens = self.token[self.firsts[doc] : self.firsts[doc + 1]]
        first, counts = self.starts[tokens], self.starts[tokens + 1] - self.starts[tokens]
        at = spread(first, counts)
        total = np.bincount(self.doc[at], weights=self.score[at], minlength=self.count)
        left = np.flatnonzero(unused)
        return left[np.argsort(-total[left], kind="stable")]


def _packed(ids: np.ndarray, offsets: np.ndarray, known: Statistics, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, first id, end) of one shard; all but the last are full.

    Whole windows of a long document come first, by themselves. A seed is the first document with
    ids left; its neighbours follow it, best first, until the window is full; the one that does not fit is
    cut, and what is left of it is the next seed.
    """
    length = np.diff(offsets)
    begun = length // window * window
    for doc in np.flatnonzero(begun):
        for at in range(0, int(begun[doc]), window):
            yield [(int(doc), at, at + window)]
    unused = begun < length
    shard = Shard(ids, offsets, known)
    seed, rest = -1, None
    while unused.any():
        seed = rest if rest is not None else int(np.argmax(unused))
        rest, room, sequence = None, window, []
        unused[seed] = False
        order = [seed]
        if length[seed] - begun[seed] < window:
            order = np.concatenate(([seed], shard.neighbours(seed, unused)))
        for doc in order:
            take = min(room, int(length[doc] - begun[doc]))
            sequence.append((int(doc), int(begun[doc]), int(begun[doc]) + take))
            begun[doc] += take
            room -= take
            unused[doc] = begun[doc] < length[doc]
            if not room:
                rest = int(doc) if unused[doc] else None
                break
        yield sequence


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` ids: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``with_ids`` the ids themselves.

    Texts are encoded once and stored with the corpus's document frequencies, one per token of the
    vocabulary, so BM25 weighs tokens by the whole corpus. The index is sharded: each task reads
    stored documents in shards of about half a million ids and looks for neighbours there, which needs no
    shuffle. A shard's last, unfilled sequence opens the next shard of its task; only a task's last
    one is short, to be padded to the next power of two. A sequence_id is made of the task's number and a
    count there.

    Null texts are empty and still have ``end_id``. A document longer than a shard makes one of its own.
    Equal texts are each other's best neighbours. Repeated rows stay; other columns are not read.
    """
    tokens = stored(spark, tokenised(docs, tokenizer, end_id), "tokens")
    shared = spark.sparkContext.broadcast(statistics(tokens))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[int | None, int, int, np.ndarray]] = []

        def emit(last: bool) -> pa.RecordBatch:
            """Pieces of the held documents; those of an unfilled sequence are held again unless it is the last."""
            nonlocal held, made
            parts = [h[3] for h in held]
            ids = np.concatenate(parts)
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            out, again = [], []
            for sequence in _packed(ids, offsets, shared.value, window):
                size = sum(b - a for _, a, b in sequence)
                at = 0
                for doc, a, b in sequence:
                    doc_id, total, before, own = held[doc]
                    if size < window and not last:
                        again.append((doc_id, total, before + a, own[a:b].copy()))
                        continue
                    out.append((doc_id, before + a, b - a, zlib.crc32(own[a:b].tobytes()), total, task + made, at, own[a:b]))
                    at += b - a
                made += not again
            held = again
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns = list(zip(*out)) if out else [[]] * 8
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            if with_ids:
                names.append("ids")
                ends = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
                flat = np.concatenate([*columns[7], np.zeros(0, np.uint32)]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        size = 0
        for batch in batches:
            lists = batch.column("ids")
            values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), ends[:-1], ends[1:]):
                held.append((doc_id, int(b - a), 0, values[a:b].astype(np.uint32)))
                size += b - a
                if size >= SHARD_TOKENS:
                    yield emit(last=False)
                    size = sum(len(h[3]) for h in held)
        if held:
            yield emit(last=True)
        give_back()

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return tokens.where("kind = 0").select("doc_id", "ids").mapInArrow(rows, schema)
