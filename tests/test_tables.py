"""Stored tables: rebuilds, incremental loads, month loads, seeds, descriptions, contracts, files."""

from __future__ import annotations

import datetime as dt
import gzip
import os

import pyarrow.parquet as pq
import pytest
from build import at, edit, edits, navigations
from pyspark.sql import functions as F

from editpulse.operators import quality
from editpulse.operators.upsert import incremental_upsert, keep_mark, loaded_until, since
from editpulse.plans import descriptions, serving
from editpulse.plans.contracts import CONTRACTS
from editpulse.plans.warehouse import ALL, CatalogWarehouse, relations
from editpulse.sinks import jdbc, tables
from editpulse.sources.lookups import read_table, table_exists, wiki_geo
from editpulse.sources.navigation import read_clickstream, resolve_dump_path
from editpulse.sources.topics import TOPIC_ASIS, topic_options


@pytest.fixture()
def warehouse(spark, work_dir):
    prefix = f"t{abs(hash(work_dir)) % 10**8}_"
    built = CatalogWarehouse(spark, as_of=at(60), location=work_dir, prefix=prefix)
    raw = edits(
        spark,
        edit(1, 0, title="A", user="10.0.0.1", anon=True), edit(2, 1, title="A"), edit(3, 2, title="B", bot=True),
        edit(4, 3, title="C", wiki="dewiki", comment="undo"),
    )
    built.store("raw.stg_edit", raw)
    clicks = navigations(spark, ("other-search", "A", "external", 5), ("A", "B", "link", 3))
    tables.land_clickstream(spark, clicks, built.name("raw.stg_clickstream"))
    built.build()
    return built


def test_build_and_contracts(spark, warehouse):
    found = relations(warehouse)
    assert set(found) == set(ALL)
    checks = quality.run_contracts(CONTRACTS, found).collect()
    assert len(checks) == 61 and sum(r.violations for r in checks) == 0
    health = serving.warehouse_health({n: warehouse.find(n) for n in (*ALL, "marts.none")}, {"raw.stg_edit": "ingested_at"})
    counts = {r.relation: (r.n_rows, r.latest is not None) for r in health.collect()}
    assert counts["raw.stg_edit"] == (4, True) and counts["core.dim_time"] == (525_600, False)
    assert counts["marts.none"] == (0, False)
    assert table_exists(spark, warehouse.name("core.dim_page")) and read_table(spark, warehouse.name("core.nope")) is None


def test_contracts_find_seeded_violations(spark, warehouse):
    found = relations(warehouse)
    fact = found["core.fact_edit"]
    broken = fact.withColumns({"page_id": F.lit(5).cast("bigint"), "ts": F.when(F.col("edit_id") > 2, F.col("ts"))})
    found["core.fact_edit"] = broken.unionByName(broken.where("edit_id = 1"))
    found["core.dim_editor"] = found["core.dim_editor"].withColumn("editor_type", F.lit("robot"))
    bad = {(r.relation, r.check, r.column): r.violations for r in quality.run_contracts(CONTRACTS, found).collect() if r.violations}
    assert bad == {
        ("core.fact_edit", "unique", "edit_id"): 1,
        ("core.fact_edit", "not_null", "ts"): 3,
        ("core.fact_edit", "relationships", "page_id"): 1,
        ("core.dim_editor", "accepted_values", "editor_type"): 3,
    }
    assert quality.expect_not_null(found["core.fact_edit"], "ts").count() == 3
    assert quality.expect_relationships(broken, "page_id", found["core.dim_page"], "page_id").collect()[0].n_rows == 4


def test_freshness(spark):
    rows = edits(spark, edit(1, 0, ingested_at=at(0)))
    status = [quality.expect_fresh(rows, as_of=at(m)).first().status for m in (5, 5.1, 30, 31)]
    assert status == ["pass", "warn", "warn", "error"]
    assert quality.expect_fresh(rows.where("false"), as_of=at(0)).first().status == "error"


def fact(warehouse):
    rows = warehouse.table("core.fact_edit").select("edit_id", "bytes_changed", F.col("edit_date").cast("string"))
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def land(spark, warehouse, *rows):
    name = warehouse.name("raw.stg_edit")
    arranged = tables.arrange(edits(spark, *rows), tables.layout_for("raw.stg_edit"))
    arranged.select(*spark.table(name).columns).write.insertInto(name)


def test_incremental_load(spark, warehouse):
    day = 24 * 60
    # A new edit, a changed edit, and one that moves to another day.
    land(spark, warehouse, edit(5, 100), edit(2, 1, bytes_changed=77, ingested_at=at(101)), edit(3, day, ingested_at=at(102)))
    warehouse.build()
    want = [(1, 10, "2026-04-01"), (2, 77, "2026-04-01"), (3, 10, "2026-04-02"), (4, 10, "2026-04-01"), (5, 10, "2026-04-01")]
    assert fact(warehouse) == want
    warehouse.build()
    assert fact(warehouse) == want
    # Every edit of a day moves away: the day is gone.
    land(spark, warehouse, edit(3, 3, ingested_at=at(200)))
    warehouse.build()
    assert (3, 10, "2026-04-01") in fact(warehouse) and len(fact(warehouse)) == 5
    dates = spark.sql(f"SHOW PARTITIONS {warehouse.name('core.fact_edit')}").collect()
    assert [r[0] for r in dates] == ["edit_date=2026-04-01"]


def test_rows_without_a_date_are_kept(spark, warehouse):
    name = warehouse.name("core.fact_edit")

    def undated(edit_id, bytes_changed):
        row = spark.table(name).where("edit_id = 1").withColumns({"edit_id": F.lit(edit_id).cast("bigint")})
        return row.withColumns(
            {"bytes_changed": F.lit(bytes_changed), "ts": F.lit(None).cast("timestamp"), "edit_date": F.lit(None).cast("date")}
        )

    incremental_upsert(spark, name, undated(50, 1))
    incremental_upsert(spark, name, undated(51, 2))
    assert {r[0] for r in fact(warehouse)} == {1, 2, 3, 4, 50, 51}
    # Both get a date: the undated partition is gone.
    dated = spark.table(name).where("edit_id > 49").withColumn("edit_date", F.lit("2026-04-03").cast("date"))
    incremental_upsert(spark, name, dated)
    rows = fact(warehouse)
    assert len(rows) == 6 and (50, 1, "2026-04-03") in rows and (51, 2, "2026-04-03") in rows


def test_new_columns_are_appended(spark, warehouse):
    name = warehouse.name("core.fact_edit")
    for _ in range(2):
        incremental_upsert(spark, name, spark.table(name).where("edit_id = 4").withColumn("note", F.lit("n")))
    notes = {r.edit_id: r.note for r in spark.table(name).collect()}
    assert notes == {1: None, 2: None, 3: None, 4: "n"}


def test_composite_key_and_mark(spark, warehouse):
    name = "upsert_two_wikis"
    day = at(0).date()

    def rows(*of):
        return spark.createDataFrame([(wiki, i, n, day) for wiki, i, n in of], "wiki_id STRING, edit_id INT, n INT, edit_date DATE")

    rows(("en", 1, 1), ("de", 1, 2), ("en", 2, 3)).write.partitionBy("edit_date").saveAsTable(name)
    incremental_upsert(spark, name, rows(("en", 1, 9)), key=("wiki_id", "edit_id"), sort_by=("edit_id",))
    assert sorted((r.wiki_id, r.edit_id, r.n) for r in spark.table(name).collect()) == [("de", 1, 2), ("en", 1, 9), ("en", 2, 3)]
    incremental_upsert(spark, name, rows(("en", 1, 7)), key=("edit_date", "wiki_id", "edit_id"))
    assert sorted((r.wiki_id, r.edit_id, r.n) for r in spark.table(name).collect()) == [("de", 1, 2), ("en", 1, 7), ("en", 2, 3)]
    keep_mark(spark, name, 12)
    assert loaded_until(spark, name) == 12


def test_scheduled_load_prunes_ingest_dates(spark, work_dir):
    landed = edits(spark, edit(1), edit(2, minute=2000)).withColumn("ingest_date", F.to_date("ingested_at"))
    landed.write.partitionBy("ingest_date").parquet(f"{work_dir}/landed")
    mark = int(at(1000).timestamp() * 1_000_000)
    new = since(spark.read.parquet(f"{work_dir}/landed"), mark)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "ingest_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.edit_id for r in new.collect()] == [2]


def test_month_loads(spark, warehouse):
    name = warehouse.name("raw.stg_clickstream")
    april = navigations(spark, ("A", "B", "link", 3))
    may = navigations(spark, ("A", "B", "link", 9, "enwiki", dt.date(2026, 5, 1)))
    tables.land_clickstream(spark, april, name)
    assert spark.table(name).count() == 3
    tables.land_clickstream(spark, may, name, mode="replace_month")
    tables.land_clickstream(spark, april, name, mode="replace_month")
    assert sorted(r.nav_count for r in spark.table(name).collect()) == [3, 9]


def test_seed_and_docs(spark, warehouse):
    name = warehouse.name("core.dim_wiki")
    seed = spark.table(name).withColumn("family", F.lit("seeded"))
    extra = seed.limit(1).withColumn("wiki_id", F.lit("xwiki"))
    tables.seed_if_absent(spark, seed.unionByName(extra), name, "wiki_id")
    assert {r.wiki_id: r.family for r in spark.table(name).collect()} == {"enwiki": "wikipedia", "dewiki": "wikipedia", "xwiki": "seeded"}
    tables.persist_docs(spark, name, "All wikis' names", {"wiki_id": "Natural key"})
    described = {r.col_name: (r.data_type, r.comment) for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["wiki_id"][1] == "Natural key" and described["Comment"][0] == "All wikis' names"


def test_stored_relations_are_described(spark, warehouse):
    for name in (n for n in ALL if n != "raw.stg_clickstream"):
        rows = {r.col_name: r for r in spark.sql(f"DESCRIBE EXTENDED {warehouse.name(name)}").collect()}
        columns = warehouse.table(name).columns
        assert rows["Comment"].data_type == descriptions.TABLES[name]
        assert all(rows[c].comment == descriptions.COLUMNS[c] for c in columns), name


def test_views(spark):
    tables.materialize_view(edits(spark, edit(1)), "some_edits")
    assert spark.table("some_edits").count() == 1


@pytest.mark.parametrize("quote", ['"', ""])
def test_dump_files(spark, work_dir, quote):
    lines = ["other-search\tA\texternal\t5", "B\tA\tlink\t0", "B\t\tlink\t4", "B\tC\tlink\tmany", "B\tC\tlink\t-1", '"B\tC\tlink\t7']
    with gzip.open(f"{work_dir}/clickstream-enwiki-2026-04.tsv.gz", "wt") as f:
        f.write("\n".join(lines))
    rows = read_clickstream(spark, work_dir, quote=quote, spread=2).collect()
    # With the default quote the row with the unclosed quote is lost.
    assert sorted(r.nav_count for r in rows) == ([5] if quote else [5, 7])
    assert {(r.wiki_db, r.dump_month) for r in rows} == {("enwiki", dt.date(2026, 4, 1))}


def test_plain_dump_wins(spark, work_dir):
    with pytest.raises(FileNotFoundError):
        resolve_dump_path(spark, work_dir, "en", "2026-04")
    for name in ("clickstream-enwiki-2026-04.tsv.gz", "clickstream-enwiki-2026-04.tsv"):
        open(os.path.join(work_dir, name), "w").close()
        assert resolve_dump_path(spark, work_dir, "en", "2026-04").endswith(name)


def test_connection_options():
    assert topic_options("h:1", "t")["startingOffsets"] == "earliest"
    assert topic_options("h:1", "t", **TOPIC_ASIS)["maxOffsetsPerTrigger"] == "5000"
    assert topic_options("h:1", "t", startingOffsets="earliest")["startingOffsets"] == "earliest"
    url = jdbc.postgres_url("h", 5432, "d", untyped_strings=True)
    assert url == "jdbc:postgresql://h:5432/d?stringtype=unspecified"
    options = jdbc.jdbc_options(url, "raw.stg_edit", "u", "p", jdbc.STREAM_BATCH_SIZE, "org.postgresql.Driver")
    assert options["batchsize"] == "1000" and options["dbtable"] == "raw.stg_edit"


def test_wiki_positions(spark):
    assert wiki_geo(spark).count() == 49


def test_facts_can_be_looked_up_by_four_keys(spark, work_dir):
    """Row groups are skipped for a page, an editor, a wiki and a time; Bloom filters are asked for on ids."""
    wikis = F.element_at(F.array(*map(F.lit, ("dewiki", "enwiki", "frwiki", "ptwiki", "zhwiki"))), (F.col("id") % 5 + 1).cast("int"))
    rows = spark.range(120_000).select(
        F.col("id").alias("edit_id"), F.xxhash64(F.col("id") % 997, F.lit(1)).alias("page_id"), F.xxhash64(F.col("id") % 1009).alias("editor_id"),
        wikis.alias("wiki_id"), F.timestamp_seconds(F.lit(1775001600) + F.col("id") * 7919 % 86400).alias("ts"),
    )
    layout = tables.layout_for("core.fact_edit")
    name = f"looked_up_{abs(hash(work_dir)) % 10**8}"
    arranged = tables.arrange(rows, layout).write.format("parquet").options(**layout.options()).option("parquet.block.size", "65536")
    arranged.partitionBy("edit_date").saveAsTable(name)
    one = rows.where("edit_id = 77").first()

    def groups():
        for path in spark.table(name).inputFiles():
            footer = pq.ParquetFile(path.removeprefix("file://")).metadata
            for g in range(footer.num_row_groups):
                yield {footer.row_group(g).column(c).path_in_schema: footer.row_group(g).column(c) for c in range(footer.num_columns)}

    found = list(groups())
    assert len(found) > 40
    for column in ("page_id", "editor_id", "wiki_id", "ts"):
        wanted = one[column]
        if column == "ts":
            wanted = wanted.astimezone(dt.timezone.utc)
        spans = [(g[column].statistics.min, g[column].statistics.max) for g in found]
        spans = [tuple(x.astimezone(dt.timezone.utc) if isinstance(x, dt.datetime) else x for x in s) for s in spans]
        assert sum(not low <= wanted <= high for low, high in spans) > len(spans) / 4, column
    incremental_upsert(spark, name, rows.where("edit_id < 3").withColumn("edit_date", F.to_date("ts")), sort_by=layout.sort_by)
    # Parquet leaves a filter out where a dictionary holds all values of a row group, as it does here.
    assert layout.options() == {f"parquet.bloom.filter.enabled#{c}": "true" for c in ("page_id", "editor_id")}
    assert spark.table(name).count() == 120_000
