"""Distributed numbering and ranking against plain Python, with one group holding most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from editpulse.operators.numbering import first_per_key, latest_per_key, number_rows, rank_by_count


@pytest.mark.parametrize("step", [7, 100_000])
def test_number_rows(spark, step):
    random.seed(1)
    rows = [("m", "hot", "x", 1)] * 400 + [
        (random.choice("ab"), random.choice(["hot", "t1", "é", None]), random.choice("xyz"), random.randrange(3))
        for _ in range(600)
    ]
    frame = spark.createDataFrame(rows, "a STRING, b STRING, c STRING, d INT").repartition(5)
    numbered = number_rows(spark, frame, ["a", "b"], "id", copies_per_step=step).orderBy("id").collect()
    assert [r.id for r in numbered] == list(range(1, 1001))
    want = sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
    assert [tuple(r)[1:] for r in numbered] == want


def test_number_no_rows(spark):
    empty = spark.createDataFrame([], "a STRING, b INT")
    assert number_rows(spark, empty, ["a"], "id").collect() == []


@pytest.mark.parametrize("hot_rows", [1, 10, 1_000_000])
def test_rank_by_count(spark, hot_rows):
    random.seed(2)
    rows = [(0 if random.random() < 0.5 else random.randrange(5), random.choice("ab"), i, random.randrange(1, 6)) for i in range(500)]
    frame = spark.createDataFrame(rows, "minute INT, wiki STRING, page INT, n BIGINT")
    ranked = rank_by_count(frame, "n", ["minute"], ["wiki"], "rank", "dense", "page", hot_rows).collect()
    assert len(ranked) == len(rows)
    for row in ranked:
        peers = [r for r in rows if r[0] == row.minute]
        assert row.rank == 1 + sum(r[3] > row.n for r in peers)
        assert row.dense == 1 + len({r[3] for r in peers if r[1] == row.wiki and r[3] > row.n})


def test_hot_minute_is_not_one_task(spark):
    """All rows of one minute with the same count end up in several partitions."""
    minute = F.when(F.col("id") < 3900, 0).otherwise(F.col("id"))
    rows = spark.range(4000).select(
        minute.alias("minute"), F.lit("w").alias("wiki"), F.col("id").alias("page"), F.lit(1).cast("bigint").alias("n")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_by_count(rows, "n", ["minute"], ["wiki"], "rank", "dense", "page", hot_rows=100)
        parts = ranked.select("minute", F.spark_partition_id().alias("part")).collect()
        hot = [sum(1 for r in parts if r.minute == 0 and r.part == p) for p in range(8)]
        assert len(parts) == 4000 and sum(hot) == 3900 and max(hot) < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_row_per_key(spark):
    rows = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, 5, "d")], "k INT, t INT, v STRING")
    assert sorted(latest_per_key(rows, ["k"], ["t"]).collect()) == [(1, 20, "c"), (2, 5, "d")]
    assert sorted(first_per_key(rows, ["k"], ["t"]).collect()) == [(1, 10, "a"), (2, 5, "d")]
