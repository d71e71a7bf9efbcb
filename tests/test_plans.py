"""Plans: no products of tables, no Python in the rows' way, filters and columns reach the files."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from editpulse.plans import registered, serving

SF_DIR = "/root/testdata/sf0.001"
# Enough for whole descriptions of scans.
LONG = "spark.sql.maxMetadataStringLength"
STREAMED = {"land_edits", "land_edits_idempotent", "land_edits_committed", "publish_stream", "marks_average"}


@pytest.fixture(autouse=True)
def whole_descriptions(spark):
    spark.conf.set(LONG, "5000")
    yield
    spark.conf.unset(LONG)


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry_points.queries() if not n.startswith("stream_")))
def test_no_products_and_no_python(spark, name):
    if name in STREAMED:
        pytest.skip("reads the files a stream wrote")
    plan = plan_of(entry_points.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


def test_live_queries_prune(spark):
    """Dates pick partitions, the window reaches Parquet, and only needed columns are read."""
    stored = registered.warehouse(spark, SF_DIR)
    plan = plan_of(serving.top_wikis(stored.table("raw.stg_edit"), as_of=registered.AS_OF))
    scan = plan[plan.index("FileScan") :]
    assert "PartitionFilters: [isnotnull(ingest_date" in scan
    assert "GreaterThan(ingested_at" in scan
    assert "ReadSchema: struct<wiki_db:string,ingested_at:timestamp>" in scan
    assert "TakeOrderedAndProject" in plan


def test_marts_prune(spark):
    plan = plan_of(registered.queries()["trending_per_minute"](spark, SF_DIR))
    assert "EqualTo(namespace,0)" in plan and "Not(EqualTo(is_bot,true))" in plan
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    assert not any("comment" in s or "editor_id" in s for s in schemas)
