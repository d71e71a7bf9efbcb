"""Parameterised queries over landing tables, star schema and marts.

``as_of`` stands for the current time (None: really now). Every limited result has a total
order, so it is the same on every run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions import labels
from editpulse.functions.edits import minute_of
from editpulse.operators.combine import union_all
from editpulse.operators.filters import AsOf, back, date_floor, editor_filter, live_filter, previous_filter

def _count() -> Column:
    return F.count(F.lit(1))


def _top(rows: DataFrame, n: int | None, *order: Column) -> DataFrame:
    ordered = rows.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def _share(flag: str) -> Column:
    return F.avg(F.when(F.col(flag), 1.0).otherwise(0.0))


def _live(edits: DataFrame, as_of: AsOf, **scope) -> DataFrame:
    """Rows of the trailing window, read from the partitions that can hold them."""
    floor = back(as_of, minutes=scope.get("window_min", 15))
    return date_floor(edits, scope.get("time_col", "ingested_at"), floor).where(live_filter(as_of, **scope))


# --- live activity ---------------------------------------------------------------------------


def live_kpis(edits: DataFrame, as_of: AsOf = None, exact: bool = True, **scope) -> DataFrame:
    """One row of indicators of the trailing window; ``exact=False`` estimates the distinct counts."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return _live(edits, as_of, **scope).agg(
        _count().alias("edits"),
        distinct("wiki_db").alias("wikis"),
        distinct("editor").alias("editors"),
        _share("is_anon").alias("anon_share"),
        _share("is_bot").alias("bot_share"),
        F.coalesce(F.sum(F.abs(F.col("bytes_changed").cast("bigint"))), F.lit(0)).alias("bytes_churned"),
    )


def kpi_delta(
    edits: DataFrame,
    as_of: AsOf = None,
    window_min: int = 15,
    wiki: str | None = None,
    namespace: int | None = None,
    editor_class: str = "any",
    time_col: str = "ingested_at",
    same_filter: bool = False,
) -> DataFrame:
    """Edits of the trailing window, of the one before, the difference, and the rate per minute.

    The window before counts all editors unless ``same_filter`` is set. One scan of both windows.
    """
    scope = dict(window_min=window_min, wiki=wiki, namespace=namespace, time_col=time_col)
    now = live_filter(as_of, editor_class=editor_class, **scope)
    before = previous_filter(as_of, **scope)
    if same_filter:
        before = before & editor_filter(editor_class)
    start = back(as_of, minutes=2 * window_min)
    counts = date_floor(edits, time_col, start).where(F.col(time_col) > start).agg(
        F.count_if(now).alias("edits"), F.count_if(before).alias("previous_edits")
    )
    return counts.select(
        "edits",
        "previous_edits",
        (F.col("edits") - F.col("previous_edits")).alias("delta"),
        (F.col("edits") / F.lit(window_min)).alias("edits_per_min"),
    )


def edit_timeline(edits: DataFrame, as_of: AsOf = None, **scope) -> DataFrame:
    """Edits per minute of edit time; an anonymous bot counts as anonymous and as bot."""
    per_minute = _live(edits, as_of, **scope).groupBy(minute_of(F.col("ts")).alias("minute"))
    counts = per_minute.agg(
        F.count_if(~F.col("is_anon") & ~F.col("is_bot")).alias("users"),
        F.count_if("is_anon").alias("anon"),
        F.count_if("is_bot").alias("bots"),
    )
    return counts.orderBy("minute")


def edits_by_wiki(edits: DataFrame, as_of: AsOf = None, **scope) -> DataFrame:
    return _live(edits, as_of, **scope).groupBy("wiki_db").agg(_count().alias("edits"))


def edits_by_wiki_geo(edits: DataFrame, geo: DataFrame, as_of: AsOf = None, **scope) -> DataFrame:
    """Only wikis with a map position. The lookup has 49 fixed rows."""
    return edits_by_wiki(edits, as_of, **scope).join(F.broadcast(geo), "wiki_db").select("wiki_db", "edits", "lat", "lon")


def top_wikis(edits: DataFrame, as_of: AsOf = None, n: int = 15, **scope) -> DataFrame:
    return _top(edits_by_wiki(edits, as_of, **scope), n, F.desc("edits"), F.asc("wiki_db"))


def wiki_options(edits: DataFrame, as_of: AsOf = None, n: int = 60) -> DataFrame:
    """The busiest wikis of the last 24 hours."""
    return top_wikis(edits, as_of, n, window_min=24 * 60)


def namespace_mix(edits: DataFrame, as_of: AsOf = None, n: int | None = None, **scope) -> DataFrame:
    labelled = _live(edits, as_of, **scope).groupBy(
        labels.namespace_label(F.col("namespace")).alias("ns_name")
    )
    return _top(labelled.agg(_count().alias("edits")), n, F.desc("edits"), F.asc("ns_name"))


def editor_mix(edits: DataFrame, as_of: AsOf = None, **scope) -> DataFrame:
    kind = labels.editor_kind(F.col("is_bot"), F.col("is_anon")).alias("kind")
    kinds = _live(edits, as_of, **scope).groupBy(kind).agg(_count().alias("edits"))
    return _top(kinds, None, F.desc("edits"), F.asc("kind"))


def recent_edits(edits: DataFrame, as_of: AsOf = None, n: int = 25, **scope) -> DataFrame:
    newest = _top(_live(edits, as_of, **scope), n, F.desc("ts"), F.desc("edit_id"))
    return newest.select(
        "ts",
        "wiki_db",
        "page_title",
        "editor",
        labels.ticker_who(F.col("is_bot"), F.col("is_anon")).alias("who"),
        "bytes_changed",
        "comment",
    )


# --- marts -----------------------------------------------------------------------------------


def _newest_minutes() -> list[Column]:
    return [F.desc("minute_bucket"), F.asc("rank_in_minute"), F.asc("wiki_db"), F.asc("page_title")]


def trending_rows(
    trending: DataFrame, as_of: AsOf = None, minutes: int = 60, max_rank: int = 3, limit: int | None = 500
) -> DataFrame:
    """Newest ranked rows of the look-back, down to rank ``max_rank`` or 10, whichever is lower down."""
    recent = trending.where(
        (F.col("minute_bucket") >= back(as_of, minutes=minutes)) & (F.col("rank_in_minute") <= max(max_rank, 10))
    )
    rows = _top(recent, limit, *_newest_minutes())
    return rows.select("minute_bucket", "wiki_db", "page_title", "edit_count", "rank_in_minute", "rank_in_wiki_minute")


def trending_rollup(trending: DataFrame, as_of: AsOf = None, minutes: int = 60, n: int = 15) -> DataFrame:
    """The n pages with most edits, summed over the whole look-back."""
    return _most_edited(trending.where(F.col("minute_bucket") >= back(as_of, minutes=minutes)), n)


def trending_rollup_asis(
    trending: DataFrame, as_of: AsOf = None, minutes: int = 60, n: int = 15, max_rank: int = 3
) -> DataFrame:
    """As computed: sums over the newest 500 rows of rank 10 or better, so they may be too small."""
    return _most_edited(trending_rows(trending, as_of, minutes, max_rank), n)


def _most_edited(rows: DataFrame, n: int) -> DataFrame:
    pages = rows.groupBy("wiki_db", "page_title").agg(F.sum("edit_count").alias("edit_count"))
    return _top(pages, n, F.desc("edit_count"), F.asc("wiki_db"), F.asc("page_title"))


def trending_view(
    trending: DataFrame, as_of: AsOf = None, minutes: int = 60, max_rank: int = 3, n: int = 60
) -> DataFrame:
    """The first n of all rows of the look-back that reach ``max_rank``."""
    return _ranked_view(trending_rows(trending, as_of, minutes, max_rank, limit=None), max_rank, n)


def trending_view_asis(
    trending: DataFrame, as_of: AsOf = None, minutes: int = 60, max_rank: int = 3, n: int = 60
) -> DataFrame:
    """As computed: the first n of the newest 500 rows that reach ``max_rank``."""
    return _ranked_view(trending_rows(trending, as_of, minutes, max_rank), max_rank, n)


def _ranked_view(fetched: DataFrame, max_rank: int, n: int) -> DataFrame:
    return _top(fetched.where(F.col("rank_in_minute") <= max_rank), n, *_newest_minutes())


def top_velocity(velocity: DataFrame, as_of: AsOf = None, hours: int = 6, min_accel: int = 1, n: int = 30) -> DataFrame:
    recent = velocity.where((F.col("minute_bucket") >= back(as_of, hours=hours)) & (F.col("accel") >= min_accel))
    rows = _top(
        recent, n, F.desc("accel"), F.desc("minute_bucket"), F.asc("wiki_db"), F.asc("page_title")
    )
    return rows.select("minute_bucket", "wiki_db", "page_title", "edits_this_min", "edits_lag_60", "accel")


def _candidates(candidates: DataFrame, as_of: AsOf, hours: int) -> DataFrame:
    """Candidates of the look-back with their severity."""
    recent = candidates.where(F.col("window_end") >= back(as_of, hours=hours))
    return recent.withColumn("severity", labels.severity(F.col("anon_edit_count"), F.col("revert_share")))


def _worst(rows: DataFrame, n: int | None) -> DataFrame:
    ordered = _top(
        rows,
        n,
        F.desc("anon_edit_count"),
        F.desc_nulls_last("revert_share"),
        F.desc("window_start"),
        F.asc("wiki_db"),
        F.asc("page_title"),
    )
    return ordered.select(
        "severity", "window_start", "wiki_db", "page_title",
        "anon_edit_count", "total_edit_count", "distinct_ip_classes", "revert_share",
    )


def vandalism_view(
    candidates: DataFrame, as_of: AsOf = None, hours: int = 24, severities: Sequence[str] = (), n: int | None = 30
) -> DataFrame:
    """The n worst candidates of the given severities (empty: all)."""
    rows = _candidates(candidates, as_of, hours)
    return _worst(rows.where(F.col("severity").isin(*severities)) if severities else rows, n)


def vandalism_view_asis(
    candidates: DataFrame, as_of: AsOf = None, hours: int = 24, severities: Sequence[str] = (), n: int | None = 30
) -> DataFrame:
    """As computed: the severity filter acts on the rows left by the limit."""
    rows = _worst(_candidates(candidates, as_of, hours), n)
    return rows.where(F.col("severity").isin(*severities)) if severities else rows


def vandalism_summary(candidates: DataFrame, as_of: AsOf = None, hours: int = 24) -> DataFrame:
    """Number and means (to 10 places, whatever the order of summing) of all candidates of the look-back."""
    means = ("avg_anon_edits", "avg_revert_share")
    return _summary(_candidates(candidates, as_of, hours)).withColumns({c: F.round(c, 10) for c in means})


def vandalism_summary_asis(candidates: DataFrame, as_of: AsOf = None, hours: int = 24, n: int | None = 30) -> DataFrame:
    """As computed: number and means of the n worst candidates, whatever the severity filter says."""
    return _summary(_worst(_candidates(candidates, as_of, hours), n))


def _summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        _count().alias("candidate_windows"),
        F.avg("anon_edit_count").alias("avg_anon_edits"),
        F.avg("revert_share").alias("avg_revert_share"),
    )


# --- live against history --------------------------------------------------------------------


def navigations_by_title(fact_clickstream: DataFrame, dim_page: DataFrame) -> DataFrame:
    """Navigations per title over all wikis and months.

    Summed per page id first: a page that draws most rows meets the page table as one row.
    """
    per_page = fact_clickstream.groupBy("target_page_id").agg(F.sum("nav_count").alias("_navigations"))
    titles = dim_page.select(F.col("page_id").alias("target_page_id"), "page_title")
    return per_page.join(titles, "target_page_id").groupBy("page_title").agg(F.sum("_navigations").alias("navigations"))


def top_navigations(fact_clickstream: DataFrame, dim_page: DataFrame, n: int = 25) -> DataFrame:
    totals = navigations_by_title(fact_clickstream, dim_page)
    return _top(totals, n, F.desc("navigations"), F.asc("page_title"))


def nav_type_mix(fact_clickstream: DataFrame) -> DataFrame:
    totals = fact_clickstream.groupBy("nav_type").agg(F.sum("nav_count").alias("n"))
    return _top(totals, None, F.desc("n"), F.asc("nav_type"))


def clickstream_coverage(fact_clickstream: DataFrame) -> DataFrame:
    return fact_clickstream.agg(
        _count().alias("n_rows"), F.min("dump_month").alias("first_month"), F.max("dump_month").alias("last_month")
    )


def anomaly_score(
    edits: DataFrame,
    dim_page: DataFrame,
    fact_clickstream: DataFrame,
    as_of: AsOf = None,
    hours: int = 1,
    min_live: int = 2,
    n: int = 20,
    wiki: str | None = "enwiki",
    namespace: int = 0,
) -> DataFrame:
    """Recent edits of a page over its historical navigations (at least 1)."""
    start = back(as_of, hours=hours)
    recent = date_floor(edits, "ts", start).where((F.col("ts") >= start) & (F.col("namespace") == namespace))
    if wiki is not None:
        recent = recent.where(F.col("wiki_db") == wiki)
    page = ["wiki_db", "namespace", "page_title"]
    counted = recent.groupBy(*page).agg(_count().alias("_edits"))
    known = dim_page.select(F.col("wiki_id").alias("wiki_db"), "namespace", "page_title")
    live = counted.join(known, page).groupBy("page_title").agg(F.sum("_edits").alias("live_edits"))
    live = live.where(F.col("live_edits") >= min_live)
    # Only the history of these few pages is needed, so the fact loses all others before it is summed.
    live_pages = dim_page.join(live.select("page_title"), "page_title", "left_semi")
    page_ids = live_pages.select(F.col("page_id").alias("target_page_id"))
    history = fact_clickstream.join(page_ids, "target_page_id", "left_semi")
    scored = live.join(navigations_by_title(history, live_pages), "page_title", "left").select(
        "page_title",
        "live_edits",
        F.coalesce("navigations", F.lit(0)).alias("navigations"),
        (
            F.col("live_edits").cast("double") / F.greatest(F.coalesce("navigations", F.lit(1)), F.lit(1))
        ).alias("anomaly_score"),
    )
    return _top(scored, n, F.desc("anomaly_score"), F.asc("page_title"))


# --- health ----------------------------------------------------------------------------------


def warehouse_health(relations: Mapping[str, DataFrame | None], latest_of: Mapping[str, str]) -> DataFrame:
    """(relation, n_rows, latest): row counts, and the newest ingest time where one is asked for.

    A relation that has not been built (None) counts 0 rows.
    """
    some = next(rows for rows in relations.values() if rows is not None)
    spark = some.sparkSession
    parts = []
    for name, rows in relations.items():
        label = F.lit(name).alias("relation")
        never = F.lit(None).cast("timestamp").alias("latest")
        if rows is None:
            parts.append(spark.range(1).select(label, F.lit(0).cast("bigint").alias("n_rows"), never))
            continue
        latest = F.max(latest_of[name]).alias("latest") if name in latest_of else F.max(never).alias("latest")
        parts.append(rows.agg(_count().alias("n_rows"), latest).select(label, "n_rows", "latest"))
    return union_all(parts)
