"""Adapters: edits, navigation counts, messages and marks derived from generic event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from editpulse import schemas

# The instant right after the last derived edit; stands for "now" in trailing-window queries.
AS_OF = "2026-04-01 12:00:00"

# Time is compressed 60x so that minutes hold several edits; the first event is 2026-04-01 00:00.
_TS = (
    "timestamp_micros(1775001600000000 + "
    "(unix_micros(cast(ts as timestamp)) - 1704067200000000) div 60)"
)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows of edits, one per event."""
    rows = _events(spark, sf_dir).selectExpr(
        "event_id AS edit_id",
        "event_id AS rev_id",
        "event_id - 1 AS parent_id",
        f"{_TS} AS ts",
        "concat('Page_', cast(get_json_object(props, '$.k') AS int) % 10) AS page_title",
        "CASE WHEN user_id % 11 = 0 THEN 1 ELSE 0 END AS namespace",
        "element_at(array('enwiki', 'dewiki', 'frwiktionary'), cast(user_id % 3 + 1 AS int)) AS wiki_db",
        "CASE WHEN user_id % 5 = 0 THEN concat('10.0.', user_id % 4, '.', user_id % 250) "
        "ELSE concat('User_', user_id) END AS editor",
        "user_id % 5 = 0 AS is_anon",
        "user_id % 7 = 0 AS is_bot",
        "event_type = 'click' AS is_minor",
        "cast(floor(value) AS int) - 100 AS bytes_changed",
        "CASE event_type WHEN 'error' THEN 'Reverted edits' WHEN 'signup' THEN NULL ELSE event_type END AS comment",
        "props AS raw_payload",
        f"{_TS} + INTERVAL 10 SECONDS AS ingested_at",
    )
    return rows.to(schemas.RAW_EDIT)


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows of navigation counts, one per order line."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "CASE l_returnflag WHEN 'A' THEN concat('Page_', l_suppkey % 20) "
        "WHEN 'N' THEN 'other-search' ELSE 'other-external' END AS referer",
        "concat('Page_', l_partkey % 20) AS target",
        "CASE l_returnflag WHEN 'A' THEN 'link' WHEN 'N' THEN 'external' ELSE 'other' END AS nav_type",
        "cast(l_quantity AS int) AS nav_count",
        "'enwiki' AS wiki_db",
        "cast(date_trunc('month', l_shipdate) AS date) AS dump_month",
        "cast(l_shipdate AS timestamp) AS ingested_at",
    )
    return rows.to(schemas.RAW_CLICKSTREAM)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON envelope per event; each twelfth has one of several faults or oddities.

    ``variant`` = event_id % 12 tells which: 0 a log entry, 1 no title, 2 blank user, 3 no
    timestamp, 4 no length, 5 an IPv6 editor, 6 text that is not JSON, 7 a bare-word editor of
    hex letters, 8 padded user, 9 text namespace, others plain.
    """
    rows = edits(spark, sf_dir).selectExpr("*", "edit_id % 12 AS variant")
    value = """
        CASE WHEN variant = 6 THEN concat('{bad ', edit_id) ELSE to_json(named_struct(
            'id', edit_id,
            'type', CASE WHEN variant = 0 THEN 'log' WHEN is_minor THEN 'edit' ELSE 'new' END,
            'namespace', namespace,
            'title', CASE WHEN variant <> 1 THEN page_title END,
            'comment', comment,
            'timestamp', CASE WHEN variant <> 3 THEN unix_seconds(ts) END,
            'user', CASE variant WHEN 2 THEN '   ' WHEN 5 THEN '2001:db8::1' WHEN 7 THEN 'Ada'
                    WHEN 8 THEN concat('  ', editor, ' ') ELSE editor END,
            'bot', is_bot,
            'minor', is_minor,
            'wiki', wiki_db,
            'revision', named_struct('old', parent_id, 'new', rev_id),
            'length', CASE WHEN variant <> 4 THEN named_struct('old', 100, 'new', 100 + bytes_changed) END
        )) END AS text
    """
    bad_namespace = r"""CASE WHEN variant = 9 THEN regexp_replace(text, '"namespace":[0-9]+', '"namespace":"none"')
        ELSE text END"""
    return rows.selectExpr("edit_id AS event_id", "variant", value).selectExpr(
        "event_id", "variant", "cast(NULL AS binary) AS key", f"cast({bad_namespace} AS binary) AS value"
    )


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a student's marks, one per event."""
    return _events(spark, sf_dir).selectExpr(
        "cast(NULL AS binary) AS key",
        "cast(to_json(named_struct('name', concat('S', event_id), 'math', cast(event_id % 101 AS int), "
        "'physics', cast(user_id % 101 AS int))) AS binary) AS value",
    )
