"""Every operator as a query over the given tables: name -> (session, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse import schemas
from editpulse.operators import dims, facts, quality, staging, tiles, upsert
from editpulse.operators.landing import enforce_landing, publish_cap, to_keyed_messages
from editpulse.plans import marts, serving
from editpulse.plans.contracts import CONTRACTS, FRESHNESS
from editpulse.plans.warehouse import CatalogWarehouse, FolderWarehouse, relations
from editpulse.session import new_work_dir, tune
from editpulse.sinks.tables import arrange, land, land_clickstream, layout_for
from editpulse.sources import samples
from editpulse.sources.calendar import dim_time_covering
from editpulse.sources.envelopes import check_envelopes, ingest_counters, parse_envelope, replay_envelopes, validate_envelopes
from editpulse.sources.lookups import wiki_geo
from editpulse.sources.navigation import read_clickstream
from editpulse.sources.topics import read_edit_stream
from editpulse.streaming import landing as stream_landing
from editpulse.streaming import live as stream_live
from editpulse.streaming import marks as stream_marks
from editpulse.streaming import marts as stream_marts
from editpulse.streaming import publish as stream_publish
from editpulse.streaming.run import finish, numbered_batches, start

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = samples.AS_OF
# The middle of the derived edits and a time after all of them, for the incremental queries.
MIDDAY = "2026-04-01 06:00:00"
REDELIVERED = "2026-04-01 13:00:00"

# The same with the derived half day stretched over twelve days.
STRETCHED_MIDDLE = "2026-04-08 06:00:00"
STRETCHED_AS_OF = "2026-04-13 00:00:00"

_warehouses: dict[tuple[str, str], FolderWarehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> FolderWarehouse:
    """The stored relations of one table folder, kept for the life of the Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        _warehouses[key] = FolderWarehouse(
            spark,
            new_work_dir(spark, "warehouse"),
            {
                "raw.stg_edit": lambda: samples.edits(spark, sf_dir),
                "raw.stg_clickstream": lambda: samples.clickstream(spark, sf_dir),
                "raw.messages": lambda: samples.messages(spark, sf_dir),
                "raw.marks": lambda: samples.marks(spark, sf_dir),
                "marts.live_tiles": lambda: tiles.live_tiles(warehouse(spark, sf_dir).table("raw.stg_edit")),
            },
            as_of=AS_OF,
        )
    return _warehouses[key]


def rebuild(spark: SparkSession, sf_dir: str) -> FolderWarehouse:
    """All relations from the landing tables on, written afresh."""
    _warehouses.pop((spark.sparkContext.applicationId, sf_dir), None)
    fresh = warehouse(spark, sf_dir)
    fresh.build()
    return fresh


def _edits(spark, sf_dir):
    return samples.edits(spark, sf_dir)


def _stg(spark, sf_dir):
    return staging.stg_edit(samples.edits(spark, sf_dir))


def _stg_clicks(spark, sf_dir):
    return staging.stg_clickstream(samples.clickstream(spark, sf_dir))


# --- staging, dimensions, facts --------------------------------------------------------------


def _dim_page_observed(spark, sf_dir):
    return dims.dim_page(_stg(spark, sf_dir), _stg_clicks(spark, sf_dir), first_seen="observed")


def _redelivered(spark, sf_dir) -> DataFrame:
    """All edits, and the minor ones again later with other lengths."""
    edits = _edits(spark, sf_dir)
    again = edits.where("is_minor").withColumns(
        {"ingested_at": F.lit(REDELIVERED).cast("timestamp"), "bytes_changed": F.col("bytes_changed") + 1000}
    )
    return edits.unionByName(again)


def _fact_edit_latest(spark, sf_dir):
    return facts.fact_edit(staging.stg_edit(_redelivered(spark, sf_dir)), dedupe="latest")


def _incremental_upsert(spark, sf_dir):
    """A first load up to midday, then everything newer, with a column the first load lacked."""
    first = _edits(spark, sf_dir).where(F.col("ingested_at") <= F.lit(MIDDAY).cast("timestamp"))
    target = facts.fact_edit(staging.stg_edit(first))
    source = facts.fact_edit(staging.stg_edit(_redelivered(spark, sf_dir))).withColumn("load_no", F.lit(2))
    return upsert.replace_by_key(target, upsert.newer_than(source, target), "edit_id")


def _incremental_load_stored(spark, sf_dir, indexed: bool = False):
    """The same two loads through a stored table and its high-water mark."""
    layout = layout_for("core.fact_edit")
    path = new_work_dir(spark, "loaded")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    first = _edits(spark, sf_dir).where(F.col("ingested_at") <= F.lit(MIDDAY).cast("timestamp"))
    rows = arrange(facts.fact_edit(staging.stg_edit(first)), layout)
    rows.write.partitionBy(*layout.partition_by).option("path", path).saveAsTable(name)
    landed = _redelivered(spark, sf_dir).withColumn("ingest_date", F.to_date("ingested_at"))

    def derive(new: DataFrame) -> DataFrame:
        return facts.fact_edit(staging.stg_edit(new)).withColumn("load_no", F.lit(2))

    upsert.load_incrementally(spark, name, landed, derive, sort_by=layout.sort_by, indexed=indexed)
    return spark.table(name).drop("edit_date")


def _incremental_load_indexed(spark, sf_dir):
    """The same two loads, the dates of replaced edits found by the key index."""
    return _incremental_load_stored(spark, sf_dir, indexed=True)


def _by_days(edits: DataFrame) -> DataFrame:
    """Edits with six minutes of the derived time stretched to a day, so that they cover several dates."""
    stretched = {c: F.timestamp_micros(1775001600000000 + (F.unix_micros(c) - 1775001600000000) * 24) for c in ("ts", "ingested_at")}
    return edits.withColumns(stretched)


def _refreshed(spark, sf_dir) -> CatalogWarehouse:
    """A catalog warehouse built from the edits up to a middle date, then brought up to the rest by its incremental paths.

    What lands later: the edits after that date, changes of earlier minor ones, and a new and a changed month of counts.
    """
    prefix = new_work_dir(spark, "refreshed").rsplit("-", 1)[1][:12]
    built = CatalogWarehouse(spark, as_of=STRETCHED_AS_OF, location=new_work_dir(spark, "catalog"), prefix=f"r{prefix}_")
    edits = _by_days(_edits(spark, sf_dir))
    middle = F.lit(STRETCHED_MIDDLE).cast("timestamp")
    clicks = samples.clickstream(spark, sf_dir)
    early = (F.col("dump_month") < F.lit("1997-01-01").cast("date")) & ((F.col("dump_month") != F.lit("1995-06-01").cast("date")) | (F.col("nav_count") < 25))
    built.store("raw.stg_edit", edits.where(F.col("ingested_at") <= middle))
    clicks.where(early).withColumn("ingested_at", middle).write.format("parquet").partitionBy("wiki_db", "dump_month").saveAsTable(built.name("raw.stg_clickstream"))
    built.build()
    changed = edits.where((F.col("ingested_at") <= middle) & F.col("is_minor") & (F.col("edit_id") % 97 == 0)).withColumns(
        {"ingested_at": F.lit(STRETCHED_AS_OF).cast("timestamp"), "comment": F.lit("undo")}
    )
    later = edits.where(F.col("ingested_at") > middle).unionByName(changed)
    land(later, built.name("raw.stg_edit"))
    late = clicks.where(~early).withColumn("ingested_at", F.lit(STRETCHED_AS_OF).cast("timestamp"))
    land_clickstream(spark, late, built.name("raw.stg_clickstream"))
    built.build()
    return built


_refreshed_once: dict[tuple[str, str], CatalogWarehouse] = {}


def _refreshed_table(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _refreshed_once:
            _refreshed_once[key] = _refreshed(spark, sf_dir)
        rows = _refreshed_once[key].table(name)
        return rows.drop("mart_date")

    return query


def _live_kpis_tiles(spark, sf_dir):
    """The indicators of 500 and a half minutes from stored tiles; the estimated editors only say whether they are near the exact count."""
    stored = warehouse(spark, sf_dir)
    edits = stored.table("raw.stg_edit")
    as_of = "2026-04-01 11:59:30"
    found = tiles.live_kpis_from_tiles(stored.table("marts.live_tiles"), edits, as_of=as_of, window_min=500)
    exact = serving.live_kpis(edits, as_of=as_of, window_min=500).select(F.col("editors").alias("_exact"), F.col("edits").alias("_edits"))
    near = F.abs(F.col("editors") - F.col("_exact")) <= 0.06 * F.col("_exact")
    return found.withColumn("_edits", F.col("edits")).join(exact, "_edits").withColumn("editors_near", near).drop("editors", "_exact", "_edits")


def _seed_if_absent(spark, sf_dir):
    minutes = dim_time_covering(_edits(spark, sf_dir))
    present = minutes.where(F.col("ts") < F.lit(MIDDAY).cast("timestamp"))
    return upsert.add_missing(present, minutes, "time_id")


# --- envelopes and landing -------------------------------------------------------------------


def _messages(spark, sf_dir):
    """The derived envelopes as a topic keeps them."""
    return warehouse(spark, sf_dir).table("raw.messages").select("event_id", "value")


def _parse_envelope(spark, sf_dir):
    return parse_envelope(_messages(spark, sf_dir)).drop("ingested_at", "raw_payload")


def _envelope_replay(spark, sf_dir):
    landed = parse_envelope(_messages(spark, sf_dir))
    return replay_envelopes(landed).drop("ingested_at", "raw_payload")


def _validate_envelopes(spark, sf_dir):
    return check_envelopes(_messages(spark, sf_dir)).drop("value")


def _valid(spark, sf_dir):
    return validate_envelopes(_messages(spark, sf_dir))[0]


def _as_text(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def _ingest_counters(spark, sf_dir):
    return check_envelopes(_messages(spark, sf_dir)).agg(*ingest_counters())


def _publish_cap(spark, sf_dir):
    capped = publish_cap(to_keyed_messages(_valid(spark, sf_dir)), 500)
    return capped.agg(F.count(F.lit(1)).alias("published"))


def _faulty_landing(spark, sf_dir) -> DataFrame:
    """Edits delivered twice; signups lack an editor and errors an anonymity flag."""
    edits = _redelivered(spark, sf_dir)
    return edits.withColumns(
        {
            "editor": F.when(F.col("comment").isNotNull(), F.col("editor")),
            "is_anon": F.when(~F.coalesce(F.col("comment") == "Reverted edits", F.lit(False)), F.col("is_anon")),
        }
    )


def _clickstream_tsv(spark, sf_dir):
    """Write the derived counts as the dump of a month, find and read it."""
    folder = new_work_dir(spark, "dumps")
    rows = samples.clickstream(spark, sf_dir).select(*schemas.NAVIGATION.names)
    rows.write.option("sep", "\t").option("quote", "").csv(f"{folder}/clickstream-enwiki-2026-04.tsv")
    return read_clickstream(spark, folder, "en", "2026-04", quote="").drop("ingested_at")


# --- contracts -------------------------------------------------------------------------------


def _expect_unique(spark, sf_dir):
    return quality.expect_unique(_edits(spark, sf_dir), "editor")


def _expect_relationships(spark, sf_dir):
    """Navigation targets that were never edited."""
    stored = warehouse(spark, sf_dir)
    edited = stored.table("core.fact_edit").select("page_id").distinct()
    return quality.expect_relationships(stored.table("core.fact_clickstream"), "target_page_id", edited, "page_id")


def _freshness(spark, sf_dir):
    rule = FRESHNESS
    return quality.expect_fresh(
        _edits(spark, sf_dir), rule["column"], AS_OF, rule["warn_minutes"], rule["error_minutes"]
    )


def _run_contracts(spark, sf_dir):
    return quality.run_contracts(CONTRACTS, relations(warehouse(spark, sf_dir)))


def _warehouse_health(spark, sf_dir):
    return serving.warehouse_health(relations(warehouse(spark, sf_dir)), {"raw.stg_edit": "ingested_at"})


# --- streams ---------------------------------------------------------------------------------


def _edit_stream(spark, sf_dir) -> DataFrame:
    stored = warehouse(spark, sf_dir)
    landed = stored.table("raw.stg_edit")
    return spark.readStream.schema(landed.schema).parquet(stored.path("raw.stg_edit"))


def _message_stream(spark, sf_dir, name: str = "raw.messages") -> DataFrame:
    stored = warehouse(spark, sf_dir)
    stored.table(name)
    return read_edit_stream(spark, fmt="parquet", path=stored.path(name))


def _stream_to_files(spark, rows: DataFrame) -> DataFrame:
    work = new_work_dir(spark, "stream")
    finish(start(rows, f"{work}/checkpoint", path=f"{work}/rows", interval=None))
    return spark.read.schema(rows.schema).parquet(f"{work}/rows")


def _stream_minute_counts(spark, sf_dir):
    return _stream_to_files(spark, stream_marts.minute_counts(_edit_stream(spark, sf_dir)))


def _stream_vandalism(spark, sf_dir):
    return _stream_to_files(spark, stream_marts.vandalism_windows(_edit_stream(spark, sf_dir)))


def _stream_trending(spark, sf_dir):
    counts = stream_marts.minute_counts(_edit_stream(spark, sf_dir))
    work = new_work_dir(spark, "stream")
    write = numbered_batches(f"{work}/rows", stream_marts.rank_closed_minutes)
    finish(start(counts, f"{work}/checkpoint", write_batch=write, interval=None))
    # Without a closed window there is no batch; an empty one gives the schema and the folder.
    empty = stream_marts.rank_closed_minutes(spark.createDataFrame([], counts.schema))
    empty.write.mode("ignore").parquet(f"{work}/rows/batch_id=-1")
    return spark.read.schema(empty.schema).parquet(f"{work}/rows").drop("batch_id")


def _stream_trending_live(spark, sf_dir):
    """Running ranks over three batches; a tenth of the edits comes hours late, in the last one."""
    work = new_work_dir(spark, "stream")
    edits = warehouse(spark, sf_dir).table("raw.stg_edit")
    late, half = F.col("edit_id") % 10 == 0, F.col("ts") < F.lit(MIDDAY).cast("timestamp")
    for part in (edits.where(~late & half), edits.where(~late & ~half), edits.where(late)):
        # Each run takes what arrived since the last one as one batch, in as many files as it was written to.
        part.write.mode("append").parquet(f"{work}/in")
        rows = spark.readStream.schema(edits.schema).parquet(f"{work}/in")
        finish(start(rows, f"{work}/checkpoint", write_batch=stream_live.live_trending(f"{work}/live"), interval=None))
    return stream_live.read_live(spark, f"{work}/live").drop("closed")


def _land_edits(spark, sf_dir):
    work = new_work_dir(spark, "landing")
    parsed = parse_envelope(_message_stream(spark, sf_dir))
    write = stream_landing.append_files(f"{work}/rows")
    finish(stream_landing.land_edits(parsed, write, f"{work}/checkpoint", interval=None))
    return stream_landing.read_landed(spark, f"{work}/rows").drop("raw_payload", "ingested_at", "edit_date", "ingest_date")


def _land_edits_idempotent(spark, sf_dir):
    """The same messages landed by two runs that know nothing of each other."""
    work = new_work_dir(spark, "landing")
    for run in ("first", "second"):
        parsed = parse_envelope(_message_stream(spark, sf_dir))
        write = stream_landing.append_once(spark, f"{work}/rows", f"{work}/quarantine-{run}")
        finish(stream_landing.land_edits(parsed, write, f"{work}/checkpoint-{run}", interval=None))
    return stream_landing.read_landed(spark, f"{work}/rows").drop("raw_payload", "ingested_at", "edit_date", "ingest_date")


def _land_edits_committed(spark, sf_dir):
    """The same through a commit log; the first run is also replayed after its commit."""
    work = new_work_dir(spark, "landing")
    for run in ("first", "first", "second"):
        parsed = parse_envelope(_message_stream(spark, sf_dir))
        write = stream_landing.append_committed(f"{work}/landed", f"{work}/quarantine", source=run)
        finish(stream_landing.land_edits(parsed, write, new_work_dir(spark, "checkpoint"), interval=None))
    landed = stream_landing.read_committed(spark, f"{work}/landed")
    return landed.drop("raw_payload", "ingested_at", "edit_date", "ingest_date", "batch")


def _publish_stream(spark, sf_dir):
    work = new_work_dir(spark, "publish")
    keyed = stream_publish.publishable(_message_stream(spark, sf_dir))
    finish(stream_publish.publish_to_files(keyed, f"{work}/rows", f"{work}/checkpoint", interval=None))
    return _as_text(spark.read.schema(schemas.MESSAGE).parquet(f"{work}/rows"))


def _marks_average(spark, sf_dir):
    return _stream_to_files(spark, stream_marks.with_average(_message_stream(spark, sf_dir, "raw.marks")))


# --- registration ----------------------------------------------------------------------------


def _raw(fn, **params) -> Query:
    """A query over the landed edits."""
    return lambda spark, sf_dir: fn(warehouse(spark, sf_dir).table("raw.stg_edit"), as_of=AS_OF, **params)


def _mart(fn, name: str, **params) -> Query:
    """A query over one stored mart."""
    return lambda spark, sf_dir: fn(warehouse(spark, sf_dir).table(f"marts.{name}"), as_of=AS_OF, **params)


def _star(fn, **params) -> Query:
    """A mart over the stored star schema."""
    return lambda spark, sf_dir: fn(*warehouse(spark, sf_dir).star(), **params)


def _stored(fn, *names: str, **params) -> Query:
    return lambda spark, sf_dir: fn(*[warehouse(spark, sf_dir).table(name) for name in names], **params)


_QUERIES: dict[str, Query] = {
    "stg_edit": _stg,
    "stg_clickstream": _stg_clicks,
    "dim_wiki": lambda s, d: dims.dim_wiki(_stg(s, d), _stg_clicks(s, d)).drop("created_at"),
    "dim_page": lambda s, d: dims.dim_page(_stg(s, d), _stg_clicks(s, d)).drop("first_seen"),
    "dim_page_observed": _dim_page_observed,
    "dim_editor": lambda s, d: dims.dim_editor(_stg(s, d)).drop("first_seen"),
    "dim_time": lambda s, d: dim_time_covering(_edits(s, d)),
    "fact_edit": lambda s, d: facts.fact_edit(_stg(s, d)),
    "fact_edit_latest": _fact_edit_latest,
    "fact_clickstream": lambda s, d: facts.fact_clickstream(s, _stg_clicks(s, d)),
    "incremental_upsert": _incremental_upsert,
    "incremental_load_stored": _incremental_load_stored,
    "incremental_load_indexed": _incremental_load_indexed,
    "refreshed_trending": _refreshed_table("marts.trending_per_minute"),
    "refreshed_velocity": _refreshed_table("marts.edit_velocity"),
    "refreshed_vandalism": _refreshed_table("marts.vandalism_candidates"),
    "refreshed_clickstream": _refreshed_table("core.fact_clickstream"),
    "seed_if_absent": _seed_if_absent,
    "trending_per_minute": _star(marts.trending_per_minute),
    "velocity_asis": _star(marts.velocity_asis),
    "velocity_60min": _star(marts.velocity_60min),
    "vandalism_asis": _star(marts.vandalism_asis, as_of=AS_OF),
    "vandalism_sliding": _star(marts.vandalism_sliding, as_of=AS_OF),
    "vandalism_sliding_by_ip": _star(marts.vandalism_sliding_by_ip, as_of=AS_OF),
    "live_kpis": _raw(serving.live_kpis),
    "live_kpis_filtered": _raw(
        serving.live_kpis, window_min=180, wiki="enwiki", namespace=0, editor_class="humans"
    ),
    "live_kpis_tiles": _live_kpis_tiles,
    "kpi_delta": _raw(serving.kpi_delta, window_min=60, editor_class="anonymous"),
    "kpi_delta_same_filter": _raw(serving.kpi_delta, window_min=60, editor_class="anonymous", same_filter=True),
    "edit_timeline": _raw(serving.edit_timeline, window_min=180),
    "edits_by_wiki": _raw(serving.edits_by_wiki, window_min=60, editor_class="bots"),
    "edits_by_wiki_geo": lambda s, d: serving.edits_by_wiki_geo(
        warehouse(s, d).table("raw.stg_edit"), wiki_geo(s), as_of=AS_OF, window_min=720
    ),
    "top_wikis": _raw(serving.top_wikis, n=2, window_min=720),
    "wiki_options": _raw(serving.wiki_options),
    "namespace_mix": _raw(serving.namespace_mix, n=8, window_min=720),
    "editor_mix": _raw(serving.editor_mix, window_min=720),
    "recent_edits": _raw(serving.recent_edits, n=100, window_min=60),
    "trending_view": _mart(serving.trending_view, "trending_per_minute", minutes=360),
    "trending_view_asis": _mart(serving.trending_view_asis, "trending_per_minute", minutes=360),
    "trending_rollup": _mart(serving.trending_rollup, "trending_per_minute", minutes=360),
    "trending_rollup_exact": _mart(serving.trending_rollup, "trending_per_minute", minutes=360),
    "trending_rollup_asis": _mart(serving.trending_rollup_asis, "trending_per_minute", minutes=360),
    "top_velocity": _mart(serving.top_velocity, "edit_velocity", hours=12, n=100),
    "vandalism_view": _mart(
        serving.vandalism_view, "vandalism_candidates", n=100, severities=("🔴 high", "🟡 medium")
    ),
    "vandalism_view_asis": _mart(
        serving.vandalism_view_asis, "vandalism_candidates", n=100, severities=("🔴 high", "🟡 medium")
    ),
    "vandalism_summary": _mart(serving.vandalism_summary, "vandalism_candidates"),
    "vandalism_summary_asis": _mart(serving.vandalism_summary_asis, "vandalism_candidates", n=100),
    "top_navigations": _stored(serving.top_navigations, "core.fact_clickstream", "core.dim_page", n=25),
    "nav_type_mix": _stored(serving.nav_type_mix, "core.fact_clickstream"),
    "clickstream_coverage": _stored(serving.clickstream_coverage, "core.fact_clickstream"),
    "anomaly_score": _stored(
        serving.anomaly_score, "raw.stg_edit", "core.dim_page", "core.fact_clickstream", as_of=AS_OF, hours=6
    ),
    "warehouse_health": _warehouse_health,
    "expect_not_null": lambda s, d: quality.expect_not_null(_edits(s, d), "comment"),
    "expect_unique": _expect_unique,
    "expect_accepted_values": lambda s, d: quality.expect_accepted_values(
        _stg_clicks(s, d), "nav_type", ("link", "external")
    ),
    "expect_relationships": _expect_relationships,
    "freshness": _freshness,
    "run_contracts": _run_contracts,
    "parse_envelope": _parse_envelope,
    "envelope_replay": _envelope_replay,
    "validate_envelopes": _validate_envelopes,
    "keyed_messages": lambda s, d: _as_text(to_keyed_messages(_valid(s, d))),
    "publish_cap": _publish_cap,
    "ingest_counters": _ingest_counters,
    "landing_good": lambda s, d: enforce_landing(_faulty_landing(s, d))[0],
    "landing_quarantine": lambda s, d: enforce_landing(_faulty_landing(s, d))[1],
    "clickstream_tsv": _clickstream_tsv,
    "land_edits": _land_edits,
    "land_edits_idempotent": _land_edits_idempotent,
    "land_edits_committed": _land_edits_committed,
    "publish_stream": _publish_stream,
    "stream_minute_counts": _stream_minute_counts,
    "stream_trending": _stream_trending,
    "stream_trending_live": _stream_trending_live,
    "stream_vandalism": _stream_vandalism,
    "marks_average": _marks_average,
}


def _zone_free(rows: DataFrame) -> DataFrame:
    """Timestamps without zone, in UTC, as the given tables have them."""
    return rows.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in rows.schema
        ]
    )


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _zone_free(query(tune(spark), sf_dir))

    return run


def queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in _QUERIES.items()}
