"""Fixed schemas. Nothing in this library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _INT, _TEXT, _FLAG, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Field names and types of the change-event envelope (fixed values of the feed).
ENVELOPE = _struct(
    id=_LONG, type=_TEXT, namespace=_INT, title=_TEXT, comment=_TEXT, timestamp=_LONG, user=_TEXT,
    bot=_FLAG, minor=_FLAG, wiki=_TEXT,
    revision=_struct(old=_LONG, new=_LONG), length=_struct(old=_INT, new=_INT),
)

# Tab-separated navigation counts, no header.
NAVIGATION = _struct(referer=_TEXT, target=_TEXT, nav_type=_TEXT, nav_count=_INT)

MARKS = _struct(name=_TEXT, math=_INT, physics=_INT)

# Keyed messages as a topic delivers them.
MESSAGE = _struct(key=T.BinaryType(), value=T.BinaryType())

# Landing layout of edits, in column order.
RAW_EDIT = _struct(
    edit_id=_LONG, rev_id=_LONG, parent_id=_LONG, ts=_TIME, page_title=_TEXT, namespace=_INT, wiki_db=_TEXT,
    editor=_TEXT, is_anon=_FLAG, is_bot=_FLAG, is_minor=_FLAG, bytes_changed=_INT, comment=_TEXT,
    raw_payload=_TEXT, ingested_at=_TIME,
)
RAW_EDIT_KEY = ("edit_id", "ts")
RAW_EDIT_REQUIRED = (
    "edit_id", "ts", "page_title", "namespace", "wiki_db", "editor",
    "is_anon", "is_bot", "is_minor", "ingested_at",
)

# Landing layout of navigation counts, in column order.
RAW_CLICKSTREAM = _struct(
    referer=_TEXT, target=_TEXT, nav_type=_TEXT, nav_count=_INT, wiki_db=_TEXT,
    dump_month=T.DateType(), ingested_at=_TIME,
)
