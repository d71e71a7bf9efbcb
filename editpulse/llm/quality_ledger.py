"""Quality rules: measurements and failure bits once per document, policies and ablations over the bits."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from editpulse.llm.batches import Words, flat, slices, texts_of, words
from editpulse.llm.tables import without

WINDOW = 5
_SYMBOLS = "[#*$%&|<>]"
_MEASURED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars", "n_chars_all",
    "n_upper", "n_shouts", "longest_word",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measurements; the rule's bit is its place in the list."""

    name: str
    fails: str


# Ratios are compared as integer products, so every engine decides alike.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * word_chars"),
    Rule("duplicate_lines", "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
    Rule("duplicate_line_text", "n_lines >= 4 and 100 * dup_line_chars > 30 * n_chars_all"),
    Rule("upper_case", "n_words >= 10 and 100 * n_upper > 50 * word_chars"),
    Rule("exclamations", "n_words >= 10 and 100 * n_shouts > 30 * n_words"),
    Rule("short_words", "n_words >= 10 and word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("endless_word", "longest_word > 1000"),
)

# Versions are never changed, only added: a stored ledger can be judged by any of them.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_windows"),
    "v2": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "duplicate_line_text", "upper_case", "exclamations"),
    "v3": tuple(rule.name for rule in RULES),
}


def mask(policy: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The bits of the rules that reject."""
    places = {rule.name: place for place, rule in enumerate(rules)}
    return sum(1 << places[name] for name in set(policy))


def _mixed(codes: np.ndarray) -> np.ndarray:
    """64 well spread bits for each code; different codes give different values."""
    x = codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeated_words(split: Words, texts: int) -> np.ndarray:
    """Per text, the words inside windows of five that occur there twice or more."""
    codes, owner = split.codes, split.owners()
    if len(codes) < WINDOW:
        return np.zeros(texts, np.int64)
    whole = owner[WINDOW - 1 :] == owner[: len(codes) - WINDOW + 1]
    starts = np.flatnonzero(whole)
    value = _mixed(owner[starts].astype(np.int64) + (1 << 40))
    for step in range(WINDOW):
        value = (value ^ _mixed(codes[starts + step])) * np.uint64(0x100000001B3) + np.uint64(step + 1)
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    equal = ordered[1:] == ordered[:-1]
    again = np.zeros(len(starts), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, starts[again], 1)
    np.add.at(edges, starts[again] + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(owner[covered], minlength=texts)


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: lines with a word, those of them equal to an earlier line, and the characters of the latter."""
    count = len(texts)
    values, offsets = flat(pc.split_pattern(texts, "\n"))
    encoded = values.dictionary_encode()
    with_word = pc.match_substring_regex(encoded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    length = pc.utf8_length(encoded.dictionary).to_numpy().astype(np.int64)
    codes = encoded.indices.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(count), np.diff(offsets))
    real = with_word[codes]
    codes, owner = codes[real], owner[real]
    pairs, copies = np.unique(owner * max(1, len(length)) + codes, return_counts=True)
    extra = copies - 1
    pair_owner, pair_code = np.divmod(pairs, max(1, len(length)))
    lines = np.bincount(owner, minlength=count)
    repeated = np.bincount(pair_owner, weights=extra, minlength=count).astype(np.int64)
    chars = np.bincount(pair_owner, weights=extra * length[pair_code], minlength=count).astype(np.int64)
    return lines, repeated, chars


def _measure(texts: pa.Array) -> list[np.ndarray]:
    count = len(texts)
    split = words(texts)
    owner, n_words = split.owners(), split.counts
    length = pc.utf8_length(split.vocabulary).to_numpy().astype(np.int64)[split.codes]
    word_chars = np.bincount(owner, weights=length, minlength=count).astype(np.int64)
    longest = np.zeros(count, np.int64)
    np.maximum.at(longest, owner, length)
    upper = pc.count_substring_regex(split.vocabulary, r"\p{Lu}").to_numpy().astype(np.int64)[split.codes]
    lines, repeated_lines, repeated_chars = _lines(texts)
    return [
        n_words,
        word_chars,
        pc.count_substring_regex(texts, _SYMBOLS).to_numpy(),
        repeated_lines,
        _repeated_words(split, count),
        lines,
        repeated_chars,
        pc.utf8_length(texts).to_numpy(),
        np.bincount(owner, weights=upper, minlength=count).astype(np.int64),
        pc.count_substring(texts, "!").to_numpy(),
        longest,
    ]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` but the text, with the measurements of its whole text (null: none).

    One pass, no shuffle. Input columns named like a measurement give way.
    """
    kept = [c for c in without(docs, _MEASURED).columns if c != text]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = [pa.array(np.asarray(x, np.int64)) for x in _measure(texts_of(batch, "_text"))]
            yield pa.RecordBatch.from_arrays([batch.column("_kept"), *found], names=["_kept", *_MEASURED])

    packed = docs.select(
        F.struct(F.lit(0).alias("_none"), *[F.col(f"`{c}`") for c in kept]).alias("_kept"),
        F.col(f"`{text}`").cast("string").alias("_text"),
    )
    out = StructType().add("_kept", packed.schema["_kept"].dataType)
    for name in _MEASURED:
        out = out.add(name, LongType())
    return packed.mapInArrow(rows, out).select(*[F.col(f"_kept.`{c}`").alias(c) for c in kept], *_MEASURED)


def rule_ledger(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger: every column of ``docs`` but the text, measurements, and ``failed``, one bit per failed rule.

    Each rule is evaluated once. Null and empty texts have measurements of 0. Repeated rows stay.
    """
    bits = [F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(F.lit(0)) for place, rule in enumerate(rules)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, text).withColumn("failed", failed.cast("bigint"))


def kept_by(policy: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    """Whether a ledger row passes: none of the policy's bits is set."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy, rules))) == 0


def ablations(ledger: DataFrame, policy: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: documents it fails, fails alone (kept without it), and the policy's rejections.

    Works on the counts of distinct bit patterns, at most two to the number of rules.
    """
    wanted = mask(policy, rules)
    patterns = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(wanted)).alias("_bits")).agg(F.count(F.lit(1)).alias("_rows"))
    named = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << p).cast("bigint").alias("bit")) for p, r in enumerate(rules) if r.name in policy]))
    each = patterns.select("_bits", "_rows", named.alias("_rule")).select("_bits", "_rows", "_rule.*")
    hit = F.col("_bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("_rows")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("_bits") == F.col("bit"), F.col("_rows")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(F.col("_bits") != 0, F.col("_rows")).otherwise(0)).alias("policy_rejects"),
    )
