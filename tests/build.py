"""Small hand-made landing rows."""

from __future__ import annotations

import datetime as dt

from editpulse import schemas

START = dt.datetime(2026, 4, 1, 10, 0, tzinfo=dt.timezone.utc)


def at(minutes: float) -> dt.datetime:
    return START + dt.timedelta(minutes=minutes)


def edit(i, minute=0.0, title="P", user="User", wiki="enwiki", ns=0, anon=False, bot=False, comment="text", **more):
    row = dict(
        edit_id=i, rev_id=i, parent_id=i - 1, ts=at(minute), page_title=title, namespace=ns, wiki_db=wiki, editor=user,
        is_anon=anon, is_bot=bot, is_minor=False, bytes_changed=10, comment=comment, raw_payload=None,
        ingested_at=at(minute) + dt.timedelta(seconds=10),
    )
    row.update(more)
    return tuple(row[name] for name in schemas.RAW_EDIT.names)


def edits(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.RAW_EDIT)


def navigations(spark, *rows):
    """(referer, target, nav_type, nav_count[, wiki[, month]])"""
    full = [
        (r[0], r[1], r[2], r[3], r[4] if len(r) > 4 else "enwiki", r[5] if len(r) > 5 else dt.date(2026, 4, 1), START)
        for r in rows
    ]
    return spark.createDataFrame(full, schemas.RAW_CLICKSTREAM)
