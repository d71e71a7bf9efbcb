"""Derived columns of one edit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from editpulse.functions.network import has_ipv4_shape

# Comment words that mark a revert, matched as whole words in any case.
REVERT_WORDS = ("reverted", "undo", "rollback")
_WORD = r"\p{L}\p{N}_"
_REVERT = rf"(?i)(?<![{_WORD}])(?:{'|'.join(REVERT_WORDS)})(?![{_WORD}])"


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def time_id(ts: Column) -> Column:
    """Minute as the integer YYYYMMDDHHMM."""
    return F.date_format(ts, "yyyyMMddHHmm").cast("bigint")


def editor_type(is_bot: Column, is_anon: Column) -> Column:
    return F.when(is_bot, "bot").when(is_anon, "anon").otherwise("user")


def ip_class_v4(editor: Column, is_anon: Column) -> Column:
    """The /24 network of an anonymous IPv4 editor, else NULL."""
    return F.when(is_anon & has_ipv4_shape(editor), F.regexp_replace(editor, r"\.\d+$", ".0/24"))


def is_revert(comment: Column) -> Column:
    """NULL for a NULL comment. Word limits are Unicode letters, digits and underscore."""
    return comment.rlike(_REVERT)
