"""Steps that took one task, or more bitmaps or copies than the input has rows for."""

from __future__ import annotations

import glob
from types import SimpleNamespace

from pyspark.sql import functions as F

from editpulse.operators import bloom, facts, staging, upsert
from editpulse.plans import registered
from editpulse.sinks.tables import arrange, layout_for
from editpulse.sources import samples
from editpulse.streaming import landing

SF_DIR = "/root/testdata/sf0.001"


def _plan(rows) -> list[str]:
    return rows._jdf.queryExecution().executedPlan().toString().split("\n")


def test_bitmaps_are_made_after_the_shuffle(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("a"), F.col("id") % 1).alias("batch"), F.xxhash64("id").alias("key_hash"))
    filters = bloom.filters_of(keys, ("batch",))
    lines = _plan(filters)
    made = [i for i, line in enumerate(lines) if "partial_bitmap_construct_agg" in line][0]
    assert not any("Exchange" in line for line in lines[:made])
    assert bloom.passing(keys, filters, ("batch",), ["batch"]).count() == 20_000


def test_a_commit_is_written_by_many_tasks(spark, work_dir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edits = samples.edits(spark, SF_DIR)
        copies = spark.range(10).withColumnRenamed("id", "copy")
        many = edits.crossJoin(copies).withColumn("edit_id", F.col("copy") * 1_000_000 + F.col("edit_id")).drop("copy")
        landing.append_committed(f"{work_dir}/landed", f"{work_dir}/quarantine")(many, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(f"{work_dir}/landed/commits/batch=edits-0/part-*")) > 1
    assert landing.read_committed(spark, f"{work_dir}/landed").count() == many.count()


def test_live_trending_input_keeps_its_tasks(spark, work_dir, monkeypatch):
    want = registered._stream_trending_live(spark, SF_DIR).collect()
    edits = registered.warehouse(spark, SF_DIR).table("raw.stg_edit").repartition(4)
    monkeypatch.setattr(registered, "warehouse", lambda *_: SimpleNamespace(table=lambda name: edits))
    monkeypatch.setattr(registered, "new_work_dir", lambda *_: work_dir)
    got = registered._stream_trending_live(spark, SF_DIR)
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and want
    assert len(glob.glob(f"{work_dir}/in/part-*")) == 12
    assert len(glob.glob(f"{work_dir}/live/commits/batch=*")) == 3


def test_a_load_is_staged_once(spark, work_dir, monkeypatch):
    monkeypatch.setattr(upsert, "new_work_dir", lambda _, purpose: f"{work_dir}/{purpose}")
    layout = layout_for("core.fact_edit")
    edits = samples.edits(spark, SF_DIR)
    first = facts.fact_edit(staging.stg_edit(edits.where("edit_id % 2 = 0")))
    arrange(first, layout).write.partitionBy(*layout.partition_by).option("path", f"{work_dir}/t").saveAsTable("staged_once")
    later = edits.withColumn("ingested_at", F.lit(registered.REDELIVERED).cast("timestamp"))
    upsert.load_incrementally(spark, "staged_once", later, lambda new: facts.fact_edit(staging.stg_edit(new)), sort_by=layout.sort_by)
    got = spark.table("staged_once").drop("edit_date")
    assert got.exceptAll(facts.fact_edit(staging.stg_edit(later))).count() == 0 and got.count() == edits.count()
    assert glob.glob(f"{work_dir}/load/part-*") and not glob.glob(f"{work_dir}/upsert/new")
