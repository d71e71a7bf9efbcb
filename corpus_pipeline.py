"""The corpus pipeline: documents without toxic texts, near copies and benchmark items, pseudonymised and packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from editpulse.llm import decontaminate, ngram_join, packing, pseudonyms, toxicity
from editpulse.llm.queries import QUERY_KEY, TOKENIZER
from editpulse.llm.tables import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's threshold; the model learns from the labelled rows of the given table."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).where("not flagged").drop("score", "flagged")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(spark, docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(docs, QUERY_KEY).drop("pii")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("ngram_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("pseudonyms", without_personal_data),
    ("packing", packed),
]

# No SQL expresses the classifier, the joins on signatures, the alignments or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written as Parquet and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
