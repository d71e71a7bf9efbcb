"""Stable 64-bit surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_key(*parts: Column) -> Column:
    """Signed 64-bit key from the first 16 hex digits of md5 over ``a|b|c``.

    A NULL part gives a NULL key. Base -10 makes ``conv`` return the signed
    value, so digests with the top bit set stay inside BIGINT under ANSI.
    """
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(part.cast("string"))
    digest = F.md5(F.concat(*pieces))
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")


def page_key(wiki: Column, namespace: Column, title: Column) -> Column:
    return stable_key(wiki, namespace, title)


def article_key(wiki: Column, title: Column) -> Column:
    """Page key of a title in the article namespace."""
    return stable_key(wiki, F.lit(0), title)


def editor_key(editor: Column, editor_type: Column) -> Column:
    return stable_key(editor, editor_type)
