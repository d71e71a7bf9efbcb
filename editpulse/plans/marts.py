"""Marts over the star schema.

Where what a mart computes and what its description says differ, both exist: ``*_asis`` is what
is computed, the other name is what is described.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.functions.labels import ratio
from editpulse.operators.filters import AsOf, back, date_floor
from editpulse.operators.numbering import rank_by_count

# A window is a vandalism candidate at this many anonymous edits or this revert share.
MIN_ANON_EDITS = 3
MIN_REVERT_SHARE = 0.3


def with_wiki_and_page(rows: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame, wiki_from: str) -> DataFrame:
    """Inner joins that add page_title and wiki_db (and wiki_id where only the page knows it).

    No broadcast hint: Spark broadcasts a dimension only when its size is under the threshold.
    """
    page_columns = ["page_id", "page_title"] + (["wiki_id"] if wiki_from == "page" else [])
    named = rows.join(dim_page.select(*page_columns), "page_id")
    return named.join(dim_wiki.select("wiki_id", "wiki_db"), "wiki_id")


def edits_per_minute(fact_edit: DataFrame, include_bots: bool) -> DataFrame:
    """(minute_bucket, wiki_id, page_id, edit_count) of article pages; works on streams as well."""
    articles = fact_edit.where(F.col("namespace") == 0)
    if not include_bots:
        articles = articles.where(~F.col("is_bot"))
    return articles.groupBy("minute_bucket", "wiki_id", "page_id").agg(F.count(F.lit(1)).alias("edit_count"))


def rank_minutes(named_counts: DataFrame) -> DataFrame:
    """rank_in_minute over all wikis, rank_in_wiki_minute (dense) within a wiki."""
    return rank_by_count(
        named_counts,
        count="edit_count",
        outer=["minute_bucket"],
        inner=["wiki_id"],
        rank="rank_in_minute",
        dense_rank="rank_in_wiki_minute",
        spread_by="page_id",
    )


def trending_per_minute(fact_edit: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame) -> DataFrame:
    counts = edits_per_minute(fact_edit, include_bots=False)
    ranked = rank_minutes(with_wiki_and_page(counts, dim_wiki, dim_page, wiki_from="row"))
    return ranked.select(
        "minute_bucket", "wiki_id", "wiki_db", "page_id", "page_title",
        "edit_count", "rank_in_minute", "rank_in_wiki_minute",
    )


def _velocity(
    fact_edit: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame, earlier: Column, history: DataFrame | None = None
) -> DataFrame:
    # After counting, a page has at most one row per minute, so a window per page is bounded by time.
    counts = edits_per_minute(fact_edit, include_bots=True)
    if history is not None:
        counts = counts.unionByName(history)
    counts = counts.withColumn("edits_lag_60", earlier)
    named = with_wiki_and_page(counts, dim_wiki, dim_page, wiki_from="row")
    return named.select(
        "minute_bucket",
        "page_id",
        "page_title",
        "wiki_id",
        "wiki_db",
        F.col("edit_count").alias("edits_this_min"),
        "edits_lag_60",
        (F.col("edit_count") - F.coalesce("edits_lag_60", F.lit(0))).alias("accel"),
    )


def velocity_asis(
    fact_edit: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame, history: DataFrame | None = None
) -> DataFrame:
    """Change against the page's 60th row back; minutes without edits have no row.

    ``history``: counts of minutes before those of ``fact_edit``, as ``edits_per_minute`` gives them.
    """
    page_minutes = Window.partitionBy("page_id").orderBy("minute_bucket")
    return _velocity(fact_edit, dim_wiki, dim_page, F.lag("edit_count", 60).over(page_minutes), history)


def velocity_60min(fact_edit: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame) -> DataFrame:
    """Change against exactly 60 minutes ago; NULL where that minute had no edit."""
    hour = "INTERVAL 60 MINUTES"
    earlier = F.expr(
        "max(edit_count) OVER (PARTITION BY page_id ORDER BY minute_bucket "
        f"RANGE BETWEEN {hour} PRECEDING AND {hour} PRECEDING)"
    )
    return _velocity(fact_edit, dim_wiki, dim_page, earlier)


def recent_articles(fact_edit: DataFrame, as_of: AsOf, days: int = 7) -> DataFrame:
    start = back(as_of, days=days)
    return date_floor(fact_edit, "ts", start).where((F.col("namespace") == 0) & (F.col("ts") >= start))


_BURST = ("anon_edit_count", "total_edit_count", "_reverts")


def burst_counts() -> list[Column]:
    """The additive part of the vandalism measures."""
    return [
        F.count_if("is_anon").alias("anon_edit_count"),
        F.count(F.lit(1)).alias("total_edit_count"),
        F.count_if("is_revert").alias("_reverts"),
    ]


def is_candidate() -> Column:
    return (F.col("anon_edit_count") >= MIN_ANON_EDITS) | (F.col("revert_share") >= MIN_REVERT_SHARE)


def _vandalism(
    fact_edit: DataFrame,
    dim_wiki: DataFrame,
    dim_page: DataFrame,
    as_of: AsOf,
    window_end: Column,
    sliding: bool = False,
    by_ip: bool = False,
) -> DataFrame:
    groups = ["window", "page_id"] + (["ip_class_v4"] if by_ip else [])
    edits = recent_articles(fact_edit, as_of)
    if sliding:
        # Panes are counted once per page and network; then each goes into the two windows that hold it.
        network = ["ip_class_v4", "is_anon"]
        panes = edits.groupBy(F.window("ts", "5 minutes").alias("_pane"), "page_id", *network).agg(*burst_counts())
        starts = F.array(F.col("_pane.start") - F.expr("INTERVAL 5 MINUTES"), F.col("_pane.start"))
        counted = panes.select(F.explode(starts).alias("_start"), *groups[1:], *([] if by_ip else ["ip_class_v4"]), "is_anon", *_BURST)
        counted = counted.withColumn("window", F.struct(F.col("_start").alias("start"), (F.col("_start") + F.expr("INTERVAL 10 MINUTES")).alias("end")))
        additive = [F.sum(c).alias(c) for c in _BURST]
    else:
        counted, additive = edits.withColumn("window", F.window("ts", "5 minutes")), burst_counts()
    measured = counted.groupBy(*groups).agg(
        *additive,
        F.count_distinct(F.when(F.col("is_anon"), F.col("ip_class_v4"))).alias("distinct_ip_classes"),
    )
    measured = measured.withColumn("revert_share", ratio(F.col("_reverts"), F.col("total_edit_count")))
    candidates = measured.where(is_candidate()).select(
        F.col("window.start").alias("window_start"), window_end.alias("window_end"), "*"
    )
    named = with_wiki_and_page(candidates, dim_wiki, dim_page, wiki_from="page")
    return named.select(
        "window_start", "window_end", "page_id", "page_title", "wiki_id", "wiki_db", *groups[2:],
        "anon_edit_count", "total_edit_count", "distinct_ip_classes", "revert_share",
    )


def vandalism_asis(
    fact_edit: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Each edit counts once, in its 5-minute slot; the slot is labelled as 10 minutes long."""
    return _vandalism(
        fact_edit, dim_wiki, dim_page, as_of,
        window_end=F.col("window.start") + F.expr("INTERVAL 10 MINUTES"),
    )


def vandalism_sliding(
    fact_edit: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """10-minute windows every 5 minutes; each edit counts in both windows that hold it."""
    return _vandalism(
        fact_edit, dim_wiki, dim_page, as_of,
        window_end=F.col("window.end"),
        sliding=True,
    )


def vandalism_sliding_by_ip(
    fact_edit: DataFrame, dim_wiki: DataFrame, dim_page: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """The sliding windows per page and /24 network (NULL network: everyone else)."""
    return _vandalism(
        fact_edit, dim_wiki, dim_page, as_of,
        window_end=F.col("window.end"),
        sliding=True,
        by_ip=True,
    )
