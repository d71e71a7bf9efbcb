"""Dimension tables.

Each is one map-side-combined aggregation over the flat union of its sources, so a page, wiki or
editor that holds most of the rows shrinks to one row per task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions import wikis
from editpulse.functions.keys import editor_key, page_key


def _built_at(built_at: Column | None) -> Column:
    return F.current_timestamp() if built_at is None else built_at


def dim_wiki(stg_edit: DataFrame, stg_clickstream: DataFrame, built_at: Column | None = None) -> DataFrame:
    names = stg_edit.select("wiki_db").unionByName(stg_clickstream.select("wiki_db")).distinct()
    wiki = F.col("wiki_db")
    return names.where(wiki.isNotNull()).select(
        wiki.alias("wiki_id"),
        wiki,
        wikis.language(wiki).alias("language"),
        wikis.family(wiki).alias("family"),
        _built_at(built_at).alias("created_at"),
    )


def dim_page(
    stg_edit: DataFrame,
    stg_clickstream: DataFrame,
    first_seen: str = "build",
    built_at: Column | None = None,
) -> DataFrame:
    """Pages of both sources. Titles are compared as they are, without normalisation.

    ``first_seen="build"`` stamps the build time; ``"observed"`` takes the earliest edit of the
    page (NULL for pages only the navigation counts know).
    """
    edited = stg_edit.select("wiki_db", "namespace", "page_title", F.col("ts").alias("seen"))
    # Target and referer of one row in one pass; synthetic or unknown referers drop out as NULL.
    referer = F.when(~F.col("referer_is_external"), F.col("referer"))
    navigated = stg_clickstream.select(
        "wiki_db",
        F.lit(0).alias("namespace"),
        F.explode(F.array("target", referer)).alias("page_title"),
        F.lit(None).cast("timestamp").alias("seen"),
    )
    title, wiki, namespace = F.col("page_title"), F.col("wiki_db"), F.col("namespace")
    known = edited.unionByName(navigated).where(title.isNotNull() & wiki.isNotNull())
    keys = ("wiki_db", "namespace", "page_title")
    if first_seen == "observed":
        pages, seen = known.groupBy(*keys).agg(F.min("seen").alias("seen")), F.col("seen")
    elif first_seen == "build":
        pages, seen = known.select(*keys).distinct(), _built_at(built_at)
    else:
        raise ValueError(f"first_seen must be 'build' or 'observed', not {first_seen!r}")
    return pages.select(
        page_key(wiki, namespace, title).alias("page_id"),
        wiki.alias("wiki_id"),
        title,
        namespace,
        seen.alias("first_seen"),
    )


def dim_editor(stg_edit: DataFrame, built_at: Column | None = None) -> DataFrame:
    editors = (
        stg_edit.where(F.col("editor").isNotNull())
        .groupBy("editor", "editor_type")
        .agg(F.max("ip_class_v4").alias("ip_class_v4"))
    )
    return editors.select(
        editor_key(F.col("editor"), F.col("editor_type")).alias("editor_id"),
        F.col("editor").alias("editor_name"),
        "editor_type",
        "ip_class_v4",
        _built_at(built_at).alias("first_seen"),
    )
