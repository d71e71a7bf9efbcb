"""A convolutional text classifier for toxicity, trained in numpy by tasks that each learn from a part of all labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from editpulse.llm.batches import Words, flat, slices, texts_of, words
from editpulse.llm.tables import without
from editpulse.session import new_work_dir

# What one learner takes at a time: about so many rows, and words. Fewest parts, as few rows learn better by the mean of some learners.
PART_ROWS, PART_WORDS, LEAST_PARTS = 8192, 1 << 22, 4
# Places of the bitmap that tells most rows without a label, the embedding rows in one block of a learner's
# changes, and steps of the scores that thresholds are chosen from.
PLACES, BLOCK, BINS = 1 << 23, 1024, 1 << 16
BUCKETS, SIZE, WIDTHS, FILTERS = 1 << 18, 8, (1, 2, 3), 8
EPOCHS, BATCH, RATE = 10, 64, 0.02
LEAST = 0.5
_TRIM = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


@dataclass
class Model:
    """Hashed word embeddings, a bank of filters for each width, and a logistic layer over their maxima."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    weight: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)


def buckets_of(split: Words) -> np.ndarray:
    """Two embedding rows for each distinct word (lower case, without outer punctuation); words of punctuation share row 0."""
    trimmed = pc.replace_substring_regex(pc.utf8_lower(split.vocabulary), _TRIM, "").to_pylist()
    of = xxhash.xxh3_64_intdigest
    each = np.fromiter((of(w) if w else 0 for w in trimmed), np.uint64, len(trimmed))
    half = np.uint64(BUCKETS // 2)
    return np.stack([each % half, half + (each >> np.uint64(32)) % half], axis=1).astype(np.int64)


_GAP = max(WIDTHS) - 1


def _spaced(codes: np.ndarray, offsets: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """The words with a gap of blanks after each text, so that no filter reaches from one text into the next."""
    texts = len(offsets) - 1
    spaced = np.full(len(codes) + texts * _GAP, blank, np.int64)
    spaced[np.arange(len(codes)) + np.repeat(np.arange(texts) * _GAP, np.diff(offsets))] = codes
    return spaced, offsets + np.arange(texts + 1) * _GAP


def _pooled(model: Model, table: np.ndarray, codes: np.ndarray, offsets: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(texts, filters) maxima over each text, and with ``places`` the words at which they are reached.

    A filter's part for each of its taps is worked out once for each distinct word (a row of ``table``).
    """
    texts = len(offsets) - 1
    values = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
    where = np.zeros(values.shape, np.int64)
    spaced, bounds = _spaced(codes, offsets, len(table))
    gaps = (bounds[1:, None] - np.arange(1, _GAP + 1)).ravel()
    for k, width in enumerate(WIDTHS):
        taps = model.filters[k].transpose(0, 2, 1).reshape(width * FILTERS, SIZE) @ table.T
        taps = np.concatenate([taps, np.zeros((len(taps), 1), np.float32)], axis=1)
        for f in range(FILTERS):
            total = taps[f][spaced]
            for step in range(1, width):
                total[:-step] += taps[step * FILTERS + f][spaced[step:]]
            total[gaps] = -np.inf
            best = np.maximum.reduceat(total, bounds[:-1])
            column = k * FILTERS + f
            values[:, column] = np.maximum(best + model.bias[k][f], 0)
            if places:
                reached = np.flatnonzero(total == np.repeat(best, np.diff(bounds)))
                text, first = np.unique(np.searchsorted(bounds, reached, side="right") - 1, return_index=True)
                where[text, column] = reached[first] - text * _GAP
    return values, where


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """A score from 0 to 1 for each whole text; one without words has the score of the offset alone."""
    split = words(texts)
    return _scored(model, buckets_of(split), split.codes, split.offsets)


def _scored(model: Model, rows: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    table = model.embedding[rows[:, 0]] + model.embedding[rows[:, 1]] if len(rows) else np.zeros((1, SIZE), np.float32)
    pooled, _ = _pooled(model, table, codes, offsets)
    return _sigmoid(pooled @ model.weight + model.offset).astype(np.float64)


def fresh(seed: int = 7) -> Model:
    """An untrained model. Embeddings start near zero."""
    rng = np.random.default_rng(seed)
    return Model(
        rng.normal(0, 0.02, (BUCKETS, SIZE)).astype(np.float32),
        [rng.normal(0, 0.4, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.full(FILTERS, 0.02, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
        0.0,
    )


def train(model: Model, codes_of: np.ndarray, offsets: np.ndarray, rows: np.ndarray, labels: np.ndarray, share: float, epoch: int, seed: int = 7) -> None:
    """Adam on the log loss in place, for one of the ``EPOCHS``; classes weighted alike, where ``share`` of all rows are toxic.

    Texts are ``codes_of`` within ``offsets``, each code with two embedding rows. Only words at a maximum are moved, so words never seen stay silent.
    Only the words of a batch have moments to update.
    """
    rng = np.random.default_rng((seed, epoch))
    lengths = np.diff(offsets)
    balance = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    dense = [*model.filters, *model.bias, model.weight]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in dense]
    first, second = np.zeros_like(model.embedding), np.zeros_like(model.embedding)
    present, places_of = np.zeros(len(rows), bool), np.zeros(len(rows), np.int64)
    shift = np.zeros(2)
    turn = 0
    rate = RATE * (1 - epoch / EPOCHS)
    order = rng.permutation(len(labels))
    for at in range(0, len(order), BATCH):
        batch = order[at : at + BATCH]
        turn += 1
        counts = lengths[batch]
        ends = np.concatenate(([0], np.cumsum(counts)))
        codes = np.concatenate([codes_of[offsets[i] : offsets[i + 1]] for i in batch])
        if not len(codes):
            continue
        present[codes] = True
        used = np.flatnonzero(present)
        places_of[used] = np.arange(len(used))
        local, present[used] = places_of[codes], False
        table = model.embedding[rows[used, 0]] + model.embedding[rows[used, 1]]
        pooled, places = _pooled(model, table, local, ends, places=True)
        error = (_sigmoid(pooled @ model.weight + model.offset) - labels[batch]) * balance[batch] / len(batch)
        back = np.outer(error, model.weight) * (pooled > 0)
        grad_table = np.zeros_like(table)
        grads: list[np.ndarray] = []
        for k, width in enumerate(WIDTHS):
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            t, f = np.nonzero(back[:, part])
            g, place = back[:, part][t, f].astype(np.float32), places[:, part][t, f]
            grad = np.zeros_like(model.filters[k])
            for step in range(width):
                ok = place + step < ends[t + 1]
                word = local[place[ok] + step]
                np.add.at(grad[step].T, f[ok], g[ok, None] * table[word])
                np.add.at(grad_table, word, g[ok, None] * model.filters[k][step].T[f[ok]])
            grads.append(grad)
        grads += [back[:, k * FILTERS : (k + 1) * FILTERS].sum(axis=0).astype(np.float32) for k in range(len(WIDTHS))]
        grads.append((pooled.T @ error).astype(np.float32) + 1e-4 * model.weight)
        scale = np.sqrt(1 - 0.999**turn) / (1 - 0.9**turn)
        for p, g, (m, v) in zip(dense, grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * scale * m / (np.sqrt(v) + 1e-8)
        shift += [0.1 * (error.sum() - shift[0]), 0.001 * (error.sum() ** 2 - shift[1])]
        model.offset -= float(rate * scale * shift[0] / (np.sqrt(shift[1]) + 1e-8))
        touched = np.flatnonzero(np.abs(grad_table).max(axis=1) > 0)
        for side in range(2):
            row = rows[used[touched], side]
            row, where = np.unique(row, return_index=True)
            g = grad_table[touched[where]]
            first[row] += 0.1 * (g - first[row])
            second[row] += 0.001 * (g * g - second[row])
            model.embedding[row] -= rate * scale * first[row] / (np.sqrt(second[row]) + 1e-8)


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Rows whose labels must not be learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == 0


def _place() -> Column:
    return F.pmod(F.xxhash64("_id"), F.lit(PLACES))


def _bitmap(ids: DataFrame) -> np.ndarray:
    """Whether some id lies at each place: 1 MB, whatever the data."""
    places = ids.select(_place().alias("_place")).groupBy(F.expr("_place div 32768").alias("_block"))
    marked = np.zeros((PLACES // 32768, 4096), np.uint8)
    for row in places.agg(F.bitmap_construct_agg(F.col("_place") % 32768).alias("_bits")).collect():
        marked[row["_block"]] = np.frombuffer(bytes(row["_bits"]), np.uint8)
    return marked.ravel()


def _encoded(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``_id``, ``lang`` and the words (the pair of embedding rows as one number) of rows that may have a label."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(known))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            place = batch.column("_place").to_numpy()
            own = batch.filter(pa.array((shared.value[place >> 3] >> (place & 7)) & 1 == 1))
            split = words(texts_of(own, "text"))
            rows = buckets_of(split)
            pairs = (rows[:, 0] * BUCKETS + rows[:, 1])[split.codes]
            lists = pa.ListArray.from_arrays(pa.array(split.offsets, pa.int32()), pa.array(pairs, pa.int64()))
            yield pa.RecordBatch.from_arrays([own.column("_id"), own.column("lang"), lists], names=["_id", "lang", "words"])

    lang = F.col("lang") if "lang" in docs.columns else F.lit("")
    plain = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(lang, F.lit("")).alias("lang"))
    placed = plain.where("_id is not null").withColumn("_place", _place())
    return placed.mapInArrow(encode, "_id bigint, lang string, words array<bigint>")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, offsets, labels) of what a learner takes at a time."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = size = 0

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, counts, labels = (np.concatenate(column) for column in zip(*held))
        return values, np.concatenate(([0], np.cumsum(counts))), labels

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            values, offsets = flat(piece.column("words"))
            held.append((values.to_numpy().copy(), np.diff(offsets), piece.column("toxic").to_numpy().astype(np.int64)))
            rows, size = rows + piece.num_rows, size + len(values)
            if rows >= 2 * PART_ROWS or size >= PART_WORDS:
                yield joined()
                held, rows, size = [], 0, 0
    if held:
        yield joined()


def _dense(model: Model) -> np.ndarray:
    """All parameters but the embeddings."""
    return np.concatenate([p.ravel() for p in (*model.filters, *model.bias, model.weight)] + [[model.offset]]).astype(np.float32)


def _move(model: Model, by: np.ndarray) -> None:
    """Add to all parameters but the embeddings."""
    at = 0
    for p in (*model.filters, *model.bias, model.weight):
        p += by[at : at + p.size].reshape(p.shape)
        at += p.size
    model.offset += float(by[at])


def _round(model: Model, stored: DataFrame, share: float, epoch: int) -> None:
    """Each learner goes over its part from the same model; the model moves by the mean of their changes.

    A learner counts by its rows; an embedding row moves by the mean of those that changed it. Changes are added up by
    block on Spark, so what comes to the driver is as large as the model, however many learners there are.
    """
    shared = stored.sparkSession.sparkContext.broadcast(model)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, offsets, labels in _parts(batches):
            own = deepcopy(shared.value)
            words_of = pa.array(values).dictionary_encode()
            pairs, codes = words_of.dictionary.to_numpy(), words_of.indices.to_numpy()
            train(own, codes, offsets, np.stack([pairs // BUCKETS, pairs % BUCKETS], axis=1), labels, share, epoch)
            changes = (own.embedding - shared.value.embedding).reshape(-1, BLOCK, SIZE)
            blocks = np.flatnonzero(changes.any(axis=(1, 2)))
            sent = [(_dense(own) - _dense(shared.value)).tobytes(), *(changes[b].tobytes() for b in blocks)]
            for at in range(0, len(sent), 32):
                some = sent[at : at + 32]
                number = pa.array([-1, *blocks][at : at + 32], pa.int32())
                yield pa.RecordBatch.from_arrays([number, pa.array([float(len(labels))] * len(some)), pa.array(some, pa.binary())], names=["block", "rows", "change"])
            del own, changes, sent
            pa.default_memory_pool().release_unused()

    def mean(group: pa.Table) -> pa.Table:
        number = group.column("block")[0].as_py()
        total = weight = 0.0
        for rows, change in zip(group.column("rows").to_pylist(), group.column("change")):
            change = np.frombuffer(change.as_buffer(), np.float32).reshape((-1, SIZE) if number >= 0 else (1, -1))
            moved = change.any(axis=1, keepdims=True) if number >= 0 else np.ones((1, 1), bool)
            total, weight = total + rows * change.astype(np.float64), weight + rows * moved
        found = (total / np.maximum(weight, 1)).astype(np.float32)
        return pa.table({"block": pa.array([number], pa.int32()), "change": pa.array([found.tobytes()], pa.binary())})

    changes = stored.select("toxic", "words").mapInArrow(learn, "block int, rows double, change binary")
    moves = changes.groupBy("block").applyInArrow(mean, "block int, change binary").collect()
    shared.destroy()
    for block, change in moves:
        change = np.frombuffer(bytes(change), np.float32)
        if block < 0:
            _move(model, change)
        else:
            model.embedding[block * BLOCK : (block + 1) * BLOCK] += change.reshape(BLOCK, SIZE)


def _thresholds(model: Model, stored: DataFrame) -> dict[str, float]:
    """Per language, the threshold of the best F0.5 on these rows; '' has the one over all, for languages with few rows.

    A clean row that goes counts more than a toxic one that stays, and no threshold lies below ``LEAST``: few rows
    of a language must not make it reject what is likelier clean. Rows are counted by language and step of the
    score, so a language with many rows is never one task's work.
    """
    shared = stored.sparkSession.sparkContext.broadcast(model)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                values, offsets = flat(piece.column("words"))
                pairs, codes = np.unique(values.to_numpy(), return_inverse=True)
                found = _scored(shared.value, np.stack([pairs // BUCKETS, pairs % BUCKETS], axis=1), codes, offsets)
                step = np.minimum(found * BINS, BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([piece.column("lang"), piece.column("toxic"), pa.array(step)], names=["lang", "toxic", "step"])

    scored = stored.select("lang", "toxic", "words").mapInArrow(steps, "lang string, toxic int, step int")
    counted = scored.groupBy("lang", "step").agg(F.sum("toxic").alias("hits"), F.count(F.lit(1)).alias("rows"))
    # The row of all languages has no name.
    each = counted.select(F.explode(F.array(F.col("lang"), F.lit(None).cast("string"))).alias("lang"), "step", "hits", "rows")
    each = each.groupBy("lang", "step").agg(F.sum("hits").alias("hits"), F.sum("rows").alias("rows"))
    above = Window.partitionBy("lang").orderBy(F.desc("step"))
    f_half = 1.25 * F.sum("hits").over(above) / (F.sum("rows").over(above) + 0.25 * F.col("all"))
    placed = each.withColumn("all", F.sum("hits").over(Window.partitionBy("lang"))).where("lang is null and all > 0 or lang <> '' and all >= 20")
    best = placed.select("lang", F.struct(f_half.alias("f"), "step").alias("cut")).groupBy("lang").agg(F.max("cut").alias("cut"))
    found = {r["lang"] or "": max(LEAST, r["cut"]["step"] / BINS) for r in best.collect()}
    return {"": LEAST} | found


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on all labelled rows that are not held out: whole texts, a tenth of them (by hash of the id) for the thresholds.

    The words of these rows are stored once in the shared folder, in parts of at most about ``PART_ROWS`` rows. In each of the
    ``EPOCHS`` a learner goes over each part, all from the mean of the epoch before. Only means as large as the
    model come to the driver. Without labels of both classes the score is the
    share itself. Null texts are empty; null labels or ids teach nothing; ids with several labels take the largest.
    """
    spark = docs.sparkSession
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic in (0, 1)")
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    toward = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    sizes, learned, checked = {}, None, None
    if len(counts) == 2:
        calibrates = F.pmod(F.xxhash64("_id", F.lit("calibrate")), F.lit(10)) == 0
        rows = _encoded(docs, known).join(known, "_id").select("toxic", "lang", "words", calibrates.alias("calibrates"))
        path = new_work_dir(spark, "labelled")
        # Without a key: rows go round the parts, so that all have as many.
        rows.repartition(max(LEAST_PARTS, -(-total // PART_ROWS))).write.parquet(path)
        stored = spark.read.schema(rows.schema).parquet(path)
        learned, checked = stored.where(~F.col("calibrates")), stored.where("calibrates")
        sizes = {r[0]: r[1] for r in learned.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        silent = Model(np.zeros((BUCKETS, SIZE), np.float32), [np.zeros((w, SIZE, FILTERS), np.float32) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(len(WIDTHS) * FILTERS, np.float32), 0.0, {"": 0.5})
        silent.offset = toward
        return silent
    model = fresh()
    for epoch in range(EPOCHS):
        _round(model, learned, sizes[1] / sum(sizes.values()), epoch)
    model.offset += toward
    model.thresholds = _thresholds(model, checked)
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs``, with ``score`` (0 to 1, of the whole text alone) and ``flagged``:
    whether it reaches the threshold of the row's language (the general one if it has none).

    One pass without a shuffle; the model (about 8 MB, whatever the data) is broadcast. Null and empty texts have the score
    of a text without words. Repeated rows stay. Columns named score or flagged give way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = without(docs, ("score", "flagged"))
    names = docs.columns

    place = [c.lower() for c in names].index("text")

    def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("_row")
            yield pa.RecordBatch.from_arrays([row, row.field(place)], names=["_row", "_text"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The text crosses once, inside its row; what a slice has freed goes back before the next one.
        for batch in slices(with_text(batches), "_text", 1 << 20):
            found = scores(shared.value, texts_of(batch, "_text"))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found)], names=["_row", "score"])
            pa.default_memory_pool().release_unused()

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    out = StructType().add("_row", packed.schema["_row"].dataType).add("score", DoubleType())
    scored = packed.mapInArrow(rows, out).select(*[F.col(f"_row.`{c}`").alias(c) for c in names], "score")
    general = model.thresholds.get("", 0.5)
    threshold = F.lit(general)
    if "lang" in names:
        own = {k: v for k, v in model.thresholds.items() if k}
        for lang, value in own.items():
            threshold = F.when(F.col("lang") == lang, value).otherwise(threshold)
    return scored.withColumn("flagged", F.col("score") >= threshold)
