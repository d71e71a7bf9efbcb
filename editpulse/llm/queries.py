"""One query per operator over the whole given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm import (
    conversation_repair, decontaminate, lexical_search, minmax_dedup, ngram_join, packing, paragraph_dedup, pseudonyms, quality_ledger, sharding,
    token_files, toxicity, url_lists,
)
from editpulse.llm.tables import stored, table
from editpulse.session import new_work_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# A real run reads its key from the caller's secret store; the queries need one that never changes.
QUERY_KEY = "query-key-1"
SHARDS = 16


def op1_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.col("text").cast("binary")
    sized = docs.select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    return sharding.interleave_shards(sized, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_before", F.xxhash64("text"))
    done = pseudonyms.pseudonymise(docs, QUERY_KEY)

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).alias(f"n_{kind}")

    counts = [count(kind.name) for kind in pseudonyms.KINDS]
    return done.select("doc_id", "text", *counts, (F.xxhash64("text") != F.col("_before")).alias("changed"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "lang", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged"
    )


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch time spread over 2024, derived from their ids."""
    seconds = F.pmod(F.col("page_id") * 7919 * 613, F.lit(366 * 86400))
    at = F.timestamp_seconds(F.lit(1704067200) + seconds).cast("timestamp_ntz")
    return table(spark, sf_dir, "pages").select("page_id", "url", at.alias("fetch_time"))


def _list_events(captures: DataFrame) -> DataFrame:
    """Dated list entries derived from the pages' own sites: adds, removals and later additions by their hashes."""
    host = url_lists.host_of("url")
    site = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    segment = F.regexp_extract(url_lists.path_of("url"), r"^/([^/]+)", 1)
    sites = captures.select(site.alias("entry")).where("entry != ''")
    sections = captures.select(F.concat(site, F.lit("/"), segment).alias("entry"), site.alias("_site"), segment.alias("_segment"))
    sections = sections.where("_site != '' and _segment != ''").select("entry")
    named = sites.select("entry", F.explode(F.array(F.lit("adult"), F.lit("spam"))).alias("list")).distinct()
    named = named.unionByName(sections.select("entry", F.lit("sections").alias("list")).distinct())
    digest = F.md5(F.concat("list", F.lit("|"), "entry"))
    drawn = [F.conv(F.substring(digest, 4 * i + 1, 4), 16, 10).cast("bigint") for i in range(4)]
    day = lambda n: F.timestamp_seconds(F.lit(1704067200) + n * 86400).cast("timestamp_ntz")
    first, second, third = drawn[1] % 366, drawn[1] % 366 + 1 + drawn[2] % 120, drawn[1] % 366 + 1 + drawn[2] % 120 + 1 + drawn[3] % 120
    turns = F.array(
        F.struct(F.lit("add").alias("action"), day(first).alias("at")),
        F.struct(F.lit("remove").alias("action"), day(second).alias("at")),
        F.struct(F.lit("add").alias("action"), day(third).alias("at")),
    )
    listed = named.where(drawn[0] % 8 == 0).select("list", "entry", F.explode(turns).alias("t"))
    return listed.select("list", "entry", "t.action", "t.at")


def op4_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = _captures(spark, sf_dir)
    return url_lists.asof_filter(captures, url_lists.list_intervals(_list_events(captures)))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=1)
    return token_files.token_index(spark, path)


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with the verdicts of all policies; per document also what one rule more or less would change.

    n_pattern counts the documents with the same failed rules: the patterns, at most two to the number of rules, are what
    ablations add up. only_rule is the one rule without which policy v3 would keep the document (null if there is none).
    """
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = stored(spark, quality_ledger.rule_ledger(texts), "ledger")
    patterns = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("n_pattern"))
    wanted = F.col("failed").bitwiseAND(F.lit(quality_ledger.mask(quality_ledger.POLICIES["v3"])))
    rules = F.array(*[F.when(wanted == 1 << place, rule.name) for place, rule in enumerate(quality_ledger.RULES)])
    verdicts = {f"kept_{name}": quality_ledger.kept_by(policy) for name, policy in quality_ledger.POLICIES.items()}
    return ledger.join(patterns, "failed").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~verdicts["kept_v1"]).alias("base_failed"),
        verdicts["kept_v3"].alias("kept"), "failed", verdicts["kept_v2"].alias("kept_v2"), "n_pattern",
        F.coalesce(*[F.get(rules, F.lit(place)) for place in range(len(quality_ledger.RULES))]).alias("only_rule"),
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.ngram_join(spark, table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "text_id", "n_copies", "n_texts", "n_links")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminations(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("tie")


def op9_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), TOKENIZER)


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = paragraph_dedup.repeated_paragraphs(spark, table(spark, sf_dir, "documents"), whole=True)
    return removed.groupBy("doc_id", "kept_doc_id").agg(F.count(F.lit(1)).alias("n_paragraphs"), F.sum("words").alias("n_words"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversation rows with the faults that the query plants by crc32 of ``conv_id:turn``; nulls are one space."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    drawn = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text = F.when(drawn == 1, "").when(drawn == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = turns.select("conv_id", "turn", F.when(drawn == 4, "user").otherwise(role).alias("role"), text.alias("text"), drawn.alias("_drawn"))
    copies = F.when(F.col("_drawn") == 0, 0).when(F.col("_drawn") == 3, 2).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).drop("_drawn", "_copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    turns = damaged(given)
    found = stored(spark, conversation_repair.repairs(turns, given), "repairs")
    digests = conversation_repair.repaired_digests(turns, found)
    same = F.col("f.conv_id").eqNullSafe(F.col("d.conv_id"))
    return found.alias("f").join(digests.alias("d"), same).select("f.*", "d.repaired_sha256")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.lexical_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.minmax_dedup(spark, table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_interleaved_shards, op2_pseudonyms, op3_toxicity, op4_url_lists, op5_token_files, op6_rule_ledger, op7_ngram_join,
        op8_decontaminate, op9_bm25_packing, op10_paragraph_dedup, op11_conversation_repair, op12_lexical_search, op13_minmax_dedup,
    )}
