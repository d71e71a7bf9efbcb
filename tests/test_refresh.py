"""Incremental paths: the key index, the change log, refreshed marts and numbered months, minute tiles, panes."""

from __future__ import annotations

import datetime as dt

import pytest
from build import at, edit, edits, navigations
from pyspark.sql import functions as F

from editpulse.operators import changes, key_index, tiles
from editpulse.operators.upsert import incremental_upsert
from editpulse.plans import marts, refresh, serving
from editpulse.plans.warehouse import MARTS, CatalogWarehouse
from editpulse.sinks import tables

DAY = dt.date(2026, 1, 1)


def keyed(spark, *rows):
    return spark.createDataFrame([(i, n, d) for i, n, d in rows], "edit_id BIGINT, n INT, edit_date DATE")


@pytest.fixture()
def many(spark, request):
    name = f"many_{abs(hash(request.node.name)) % 10**8}"
    date = F.date_add(F.lit(DAY), (F.col("id") / 500).cast("int"))
    rows = spark.range(10_000).select(F.col("id").alias("edit_id"), F.lit(1).alias("n"), date.alias("edit_date"))
    rows.write.partitionBy("edit_date").saveAsTable(name)
    return name


def contents(spark, name):
    return sorted((r.edit_id, r.n, r.edit_date) for r in spark.table(name).collect())


def test_indexed_upsert_equals_the_plain_one(spark, many):
    want = {i: (1, DAY + dt.timedelta(i // 500)) for i in range(10_000)}
    loads = [
        [(777, 5, DAY), (123_456, 5, DAY + dt.timedelta(90)), (1500, 9, DAY + dt.timedelta(1))],
        [(777, 6, DAY + dt.timedelta(90)), (5, 6, DAY)],
        [(777, 7, DAY + dt.timedelta(3))],
    ]
    for rows in loads:
        touched = incremental_upsert(spark, many, keyed(spark, *rows), indexed=True, logged=True)
        assert touched == {want[i][1] for i, *_ in rows if i in want} | {d for *_, d in rows} | touched
        want |= {i: (n, d) for i, n, d in rows}
        assert contents(spark, many) == sorted((i, n, d) for i, (n, d) in want.items())
    # The same load again changes nothing.
    incremental_upsert(spark, many, keyed(spark, *loads[-1]), indexed=True, logged=True)
    assert contents(spark, many) == sorted((i, n, d) for i, (n, d) in want.items())
    assert changes.last_change(spark, many) == 4
    assert changes.changed_dates(spark, many, 0, 1) == {DAY, DAY + dt.timedelta(1), DAY + dt.timedelta(3), DAY + dt.timedelta(90)}


def test_a_lookup_reads_only_its_buckets(spark, many, monkeypatch):
    monkeypatch.setattr(key_index, "_KEYS_PER_BUCKET", 100)
    key_index.build_index(spark, many, ["edit_id"])
    buckets = key_index.buckets_of(spark, many, ["edit_id"])
    assert buckets >= 64 and key_index.buckets_of(spark, many, ["n"]) is None
    asked = key_index.hashed(keyed(spark, (7, 0, DAY), (4_321, 0, DAY), (-1, 0, DAY)), ["edit_id"], buckets)
    found = key_index.entries(spark, many, asked)
    stored = {r.bucket for r in key_index.hashed(keyed(spark, (7, 0, DAY), (4_321, 0, DAY)), ["edit_id"], buckets).collect()}
    folders = {path.split("/bucket=")[1].split("/")[0] for path in found.inputFiles() if "/bucket=" in path}
    assert stored <= set(map(int, folders)) and len(folders) <= 3
    assert {r.at for r in found.collect()} == {DAY, DAY + dt.timedelta(8)}
    # New keys pass no filter, but for about one in eighty.
    new = key_index.hashed(spark.range(20_000, 30_000).select(F.col("id").alias("edit_id")), ["edit_id"], buckets)
    old = key_index.hashed(spark.table(many), ["edit_id"], buckets)
    assert key_index.passed(spark, many, new).count() < 400 and key_index.passed(spark, many, old).count() == 10_000


def test_an_upsert_reads_only_touched_dates(spark, many):
    incremental_upsert(spark, many, keyed(spark, (1, 2, DAY)), indexed=True)
    untouched = {p for p in spark.table(many).inputFiles() if f"edit_date={DAY}" not in p}
    incremental_upsert(spark, many, keyed(spark, (2, 2, DAY)), indexed=True)
    assert untouched == {p for p in spark.table(many).inputFiles() if f"edit_date={DAY}" not in p}


def test_a_rebuilt_table_has_no_index_and_compaction_keeps_the_newest(spark, many):
    key = ["edit_id"]
    incremental_upsert(spark, many, keyed(spark, (1, 2, DAY + dt.timedelta(50))), indexed=True)
    buckets = key_index.buckets_of(spark, many, key)
    asked = key_index.hashed(keyed(spark, (1, 0, DAY)), key, buckets)
    assert key_index.dates_of(spark, many, asked) == {DAY, DAY + dt.timedelta(50)}
    key_index.compact(spark, many, key, buckets)
    assert key_index.dates_of(spark, many, asked) == {DAY + dt.timedelta(50)} and key_index.loads(spark, many) == 0
    assert spark.table(key_index.keys_table(many)).count() == 10_000
    rows = spark.createDataFrame(spark.table(many).where("edit_id < 100").collect(), spark.table(many).schema)
    rows.write.mode("overwrite").partitionBy("edit_date").saveAsTable(many)
    assert key_index.buckets_of(spark, many, key) is None
    incremental_upsert(spark, many, keyed(spark, (1, 3, DAY)), indexed=True)
    assert len(contents(spark, many)) == 100 and (1, 3, DAY) in contents(spark, many)


# --- marts and months ------------------------------------------------------------------------

HOUR = 60


@pytest.fixture()
def warehouse(spark, work_dir):
    prefix = f"i{abs(hash(work_dir)) % 10**8}_"
    built = CatalogWarehouse(spark, as_of=at(3 * 24 * HOUR), location=work_dir, prefix=prefix)
    rows = [edit(d * 1000 + m, d * 24 * HOUR + m, title="AB"[m % 2], user=f"10.0.{m % 3}.1", anon=m % 2 == 0, wiki=("enwiki", "dewiki")[m % 2]) for d in range(-2, 3) for m in range(1, 90, 7)]
    built.store("raw.stg_edit", edits(spark, *rows))
    tables.land_clickstream(spark, navigations(spark, *[("other-search", t, "external", n, "enwiki", dt.date(2026, m, 1)) for m in (2, 4) for n, t in enumerate("ABC", 1)]), built.name("raw.stg_clickstream"))
    built.build()
    return built


def rows_of(warehouse, name, fresh=False):
    rows = warehouse.derive(name) if fresh else warehouse.table(name).drop("mart_date")
    return sorted(map(repr, rows.select(*sorted(rows.columns)).collect()))


def test_marts_recompute_what_a_load_changed(spark, warehouse):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stamps = {m: {p for p in warehouse.table(m).inputFiles()} for m in MARTS}
    # A new edit on the last day, and one of the second day that moves to the third.
    tables.land(edits(spark, edit(90_000, 2 * 24 * HOUR + 5, title="A", ingested_at=at(9_000)), edit(-1_000 + 1, 5, title="B", ingested_at=at(9_000))), warehouse.name("raw.stg_edit"))
    written = warehouse.build()
    third, fifth = dt.date(2026, 4, 1), dt.date(2026, 4, 3)
    assert written["marts.trending_per_minute"] == {third - dt.timedelta(1), third, fifth}
    assert written["marts.edit_velocity"] == {third + dt.timedelta(n) for n in range(-1, 3)}
    for name in MARTS:
        assert rows_of(warehouse, name) == rows_of(warehouse, name, fresh=True), name
    kept = {p for p in stamps["marts.trending_per_minute"] if any(f"mart_date={d}" in p for d in ("2026-03-30", "2026-04-02"))}
    assert kept and kept <= set(warehouse.table("marts.trending_per_minute").inputFiles())
    assert warehouse.build()["marts.trending_per_minute"] == set()
    # Later, the first days leave the trailing week.
    warehouse.as_of = at(8 * 24 * HOUR)
    warehouse.build()
    assert rows_of(warehouse, "marts.vandalism_candidates") == rows_of(warehouse, "marts.vandalism_candidates", fresh=True)
    assert warehouse.build(full_refresh=True)["marts.edit_velocity"] is None


def test_velocity_continues_over_dates_not_read(spark):
    rows = [edit(i, i, title="P") for i in range(200)] + [edit(1000 + i, 24 * HOUR + i, title="P") for i in range(80)]
    from editpulse.operators import dims, facts, staging

    staged = staging.stg_edit(edits(spark, *rows))
    fact = facts.fact_edit(staged).withColumn("edit_date", F.to_date("ts"))
    empty = navigations(spark).withColumn("referer_is_external", F.lit(True))
    wiki, page = dims.dim_wiki(staged, empty), dims.dim_page(staged, empty)
    whole = marts.velocity_asis(fact, wiki, page).withColumn("mart_date", F.to_date("minute_bucket"))
    day = dt.date(2026, 4, 2)
    part = fact.where(F.col("edit_date") == F.lit(day))
    history = refresh._history(whole, part, day)
    assert history.count() == 60
    again = marts.velocity_asis(part, wiki, page, history).where(F.to_date("minute_bucket") == F.lit(day))
    want = whole.where(F.col("mart_date") == F.lit(day)).drop("mart_date")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, want.collect())) and again.where("edits_lag_60 = 1").count() == 80


def test_months_are_renumbered_only_where_they_change(spark, warehouse):
    name = warehouse.name("raw.stg_clickstream")
    march = navigations(spark, ("A", "B", "link", 3, "enwiki", dt.date(2026, 3, 1))).withColumn("ingested_at", F.lit("2026-06-01").cast("timestamp"))
    before = set(warehouse.table("core.fact_clickstream").inputFiles())
    tables.land_clickstream(spark, march, name)
    assert warehouse.build()["core.fact_clickstream"] == {dt.date(2026, 3, 1), dt.date(2026, 4, 1)}
    assert rows_of(warehouse, "core.fact_clickstream") == rows_of(warehouse, "core.fact_clickstream", fresh=True)
    assert {p for p in before if "dump_month=2026-02-01" in p} <= set(warehouse.table("core.fact_clickstream").inputFiles())
    assert warehouse.build()["core.fact_clickstream"] == set()
    # A month of another wiki in a month that is there already; then a month replaced by fewer rows.
    more = navigations(spark, ("A", "B", "link", 3, "dewiki", dt.date(2026, 2, 1))).withColumn("ingested_at", F.lit("2026-06-02").cast("timestamp"))
    tables.land_clickstream(spark, more, name)
    fewer = navigations(spark, ("A", "C", "link", 3, "enwiki", dt.date(2026, 4, 1))).withColumn("ingested_at", F.lit("2026-06-03").cast("timestamp"))
    tables.land_clickstream(spark, fewer, name, mode="replace_month")
    assert warehouse.build()["core.fact_clickstream"] == {dt.date(2026, m, 1) for m in (2, 3, 4)}
    assert rows_of(warehouse, "core.fact_clickstream") == rows_of(warehouse, "core.fact_clickstream", fresh=True)


def test_how_far_a_changed_date_reaches():
    d = [DAY + dt.timedelta(n) for n in range(6)]
    reach = refresh.REACH
    assert refresh.affected_dates({d[2]}, set(d), reach["marts.trending_per_minute"]) == {d[2]}
    assert refresh.affected_dates({d[2]}, set(d), reach["marts.edit_velocity"]) == set(d[2:])
    assert refresh.affected_dates({d[2]}, set(d), reach["marts.edit_velocity_60min"]) == {d[2], d[3]}
    assert refresh.affected_dates({d[2]}, set(d), reach["marts.vandalism_sliding"]) == {d[1], d[2]}
    assert refresh.affected_dates(set(), set(d), reach["marts.edit_velocity"]) == set()


# --- tiles and panes -------------------------------------------------------------------------


@pytest.mark.parametrize("seconds", [0, 17])
@pytest.mark.parametrize("scope", [{}, {"wiki": "dewiki"}, {"editor_class": "anonymous", "namespace": 1}, {"wiki": "none"}])
def test_tiles_give_the_live_indicators(spark, seconds, scope):
    rows = edits(spark, *[
        edit(i, i * 0.31, user=f"u{i % 97}", wiki=("enwiki", "dewiki")[i % 2], ns=i % 3, anon=i % 5 == 0, bot=i % 7 == 0, bytes_changed=i - 200, ingested_at=at(0) + dt.timedelta(seconds=20 * i))
        for i in range(400)
    ])
    as_of = at(0) + dt.timedelta(seconds=8000 + seconds)
    window = dict(as_of=as_of, window_min=60, **scope)
    want, got = serving.live_kpis(rows, **window).first(), tiles.live_kpis_from_tiles(tiles.live_tiles(rows), rows, **window).first()
    assert got == want


def test_sketches_are_near_for_many_editors(spark):
    rows = spark.range(200_000).select(
        F.timestamp_micros(F.col("id") * 1000).alias("ingested_at"), F.lit("w").alias("wiki_db"), F.lit(0).alias("namespace"), F.lit(False).alias("is_anon"),
        F.lit(False).alias("is_bot"), F.lit(1).alias("bytes_changed"), F.concat(F.lit("u"), F.col("id") % 50_000).alias("editor"),
    )
    found = tiles.live_kpis_from_tiles(tiles.live_tiles(rows), rows, as_of=dt.datetime(1970, 1, 1, 1), window_min=60).first()
    assert found.edits == 199_999 and abs(found.editors - 50_000) < 0.05 * 50_000


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_sliding_windows_are_counted_in_panes(spark, warehouse):
    plan = plan_of(marts.vandalism_sliding(*warehouse.star(), as_of=at(3 * 24 * HOUR)))
    below = plan[plan.rindex("HashAggregate") :]
    assert "Generate explode" in plan and "Expand" not in below and "Generate" not in below
