"""Change-event envelopes: lenient parsing for landing, strict validation for publishing.

Every function is one narrow projection or filter, so all run unchanged on batches and streams.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse import schemas
from editpulse.functions.network import is_ip_strict, looks_like_ip_loose
from editpulse.sources.topics import decode_json

# The event types that are page edits.
EDIT_TYPES = ("edit", "new")

# Seconds of 0001-01-01 and 9999-12-31T23:59:59; beyond these a timestamp has no calendar date.
_MIN_SECONDS, _MAX_SECONDS = -62135596800, 253402300799


def _epoch_to_ts(seconds: Column) -> Column:
    return F.when(seconds.between(_MIN_SECONDS, _MAX_SECONDS), F.timestamp_seconds(seconds))


def parse_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """Landing rows from messages: edits only, lenient about everything else.

    NULL or missing lengths count as 0; the loose IP shapes decide ``is_anon``.
    """
    # A generator over one decoded document: filters on its columns stay above it, so the text is
    # parsed once and not again for every predicate.
    event = messages.select(
        F.col(value).cast("string").alias("raw_payload"),
        F.inline(F.array(decode_json(F.col(value), schemas.ENVELOPE))),
    )
    edit_id = F.coalesce("revision.new", "id")
    edits = event.where(
        F.col("type").isin(*EDIT_TYPES)
        & F.col("title").isNotNull()
        & F.col("namespace").isNotNull()
        & (edit_id > 0)
    )
    columns = {
        "edit_id": edit_id,
        "rev_id": F.col("revision.new"),
        "parent_id": F.col("revision.old"),
        "ts": _epoch_to_ts(F.col("timestamp")),
        "page_title": F.col("title"),
        "wiki_db": F.col("wiki"),
        "editor": F.col("user"),
        "is_anon": looks_like_ip_loose(F.col("user")),
        "is_bot": F.coalesce("bot", F.lit(False)),
        "is_minor": F.coalesce("minor", F.lit(False)),
        "bytes_changed": F.try_subtract(F.coalesce("length.new", F.lit(0)), F.coalesce("length.old", F.lit(0))),
        "ingested_at": F.current_timestamp(),
    }
    return edits.select(*[columns.get(name, F.col(name)).alias(name) for name in schemas.RAW_EDIT.names])


def replay_envelopes(raw_edits: DataFrame) -> DataFrame:
    """Landing rows again from the payloads kept in the landing table."""
    return parse_envelope(raw_edits.where(F.col("raw_payload").isNotNull()), value="raw_payload")


# Every field as the text of its JSON value; objects stay JSON text. ``_bad`` is set for broken text.
_AS_TEXT = T.StructType([T.StructField(name, T.StringType()) for name in (*schemas.ENVELOPE.names, "_bad")])
_OLD_NEW = T.StructType([T.StructField("old", T.StringType()), T.StructField("new", T.StringType())])
_BLANK = ("null", "false", "0", "-0", "0.0", "-0.0", "", "[]", "{}")
_NAMES = ("title", "user", "wiki", "comment")
_SPACE = r"[\s\x1c-\x1f]"


def _is_blank(text: Column) -> Column:
    """Missing, null, false, zero or empty."""
    return F.coalesce(text, F.lit("null")).isin(*_BLANK)


def _integer(text: Column, kind: str = "bigint") -> Column:
    """Whole part of a number, NULL for other text."""
    return F.coalesce(text.try_cast(kind), text.try_cast("decimal(38,6)").try_cast(kind))


def _is_text(path: str) -> Column:
    """The field is a JSON string, null or missing. Parses the document again."""
    found = F.try_variant_get(F.try_parse_json("value"), f"$.{path}", "variant")
    return F.coalesce(F.schema_of_variant(found), F.lit("VOID")).isin("STRING", "VOID")


def _all_names_text() -> Column:
    """Titles and names are JSON strings. Only values spelled like a number, a truth value, a list
    or an object can be anything else, so only those few are looked at closely."""
    suspect = F.concat_ws("\n", *_NAMES).rlike(r"(?m)^(?:-?[0-9][0-9.eE+-]*|true|false|[\[{].*)$")
    return F.when(suspect, reduce(Column.__and__, map(_is_text, _NAMES))).otherwise(True)


# One JSON value other than an object and nothing after it; parsing alone would pass over what follows. Possessive,
# as Java would recurse for each character of a long string.
_OTHER_JSON = r'(?s)\A\s*+(\[.*\]|"(?:[^"\\]++|\\.)*+"|[-+.0-9eE]+|true|false|null)\s*\z'


def check_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Every message with a ``reason`` (NULL when it is a valid edit) and its model columns.

    Differs from :func:`parse_envelope` where publishing is stricter than landing: IPs must be
    valid, the editor is trimmed and must not be empty, an absent length gives NULL bytes, and a
    zero revision id falls through to the event id.

    The reason is the first rule that fails: undecodable (no JSON), not_object, type, missing (title or namespace),
    timestamp, editor, field_type. Flags and numbers given as JSON text count by their text.
    """
    kept = [c for c in messages.columns if c != value]
    text = F.col(value).cast("string")
    decoded = F.from_json(text, _AS_TEXT, {"columnNameOfCorruptRecord": "_bad"})
    fields = messages.select(*kept, text.alias("value"), F.inline(F.array(decoded)))
    for name in ("revision", "length"):
        fields = fields.withColumn(f"_{name}", F.from_json(name, _OLD_NEW))
    is_object = F.col("_bad").isNull() & F.col("value").rlike(r"(?s)\A\s*\{.*\}\s*\z")
    length_new, length_old = (F.col(f"_length.{side}") for side in ("new", "old"))
    revision_new, revision_old = (F.col(f"_revision.{side}") for side in ("new", "old"))
    parts = fields.select(
        *kept,
        "value",
        F.coalesce(is_object, F.lit(False)).alias("_is_object"),
        F.coalesce(F.col("type").isin(*EDIT_TYPES), F.lit(False)).alias("_is_edit"),
        (F.col("namespace").isNull() | F.col("title").isNull()).alias("_is_missing"),
        _integer(F.col("id")).alias("_id"),
        _integer(revision_new).alias("rev_id"),
        _integer(revision_old).alias("parent_id"),
        _epoch_to_ts(_integer(F.col("timestamp"))).alias("ts"),
        F.col("title").alias("page_title"),
        _integer(F.col("namespace"), "int").alias("namespace"),
        F.when(_is_blank(F.col("wiki")), "").otherwise(F.col("wiki")).alias("wiki_db"),
        F.regexp_replace("user", rf"(?U)\A{_SPACE}++|(?<!{_SPACE}){_SPACE}++\z", "").alias("editor"),
        (~_is_blank(F.col("bot"))).alias("is_bot"),
        (~_is_blank(F.col("minor"))).alias("is_minor"),
        F.when(
            ~_is_blank(F.col("length")),
            F.try_subtract(
                F.coalesce(_integer(length_new, "int"), F.lit(0)), F.coalesce(_integer(length_old, "int"), F.lit(0))
            ),
        ).alias("bytes_changed"),
        "comment",
        # Each part an object or blank, each id and length a whole number or blank.
        reduce(
            Column.__and__,
            [
                *[_is_blank(F.col(n)) | F.col(n).startswith("{") for n in ("revision", "length")],
                *[revision.isNull() | _integer(revision).isNotNull() for revision in (revision_new, revision_old)],
                *[_is_blank(side) | _integer(side, "int").isNotNull() for side in (length_new, length_old)],
                ~_is_blank(revision_new) | _is_blank(F.col("id")) | _integer(F.col("id")).isNotNull(),
                _all_names_text(),
            ],
        ).alias("_well_typed"),
    )
    reason = (
        F.when(
            ~F.col("_is_object"),
            F.when(
                F.col("value").rlike(_OTHER_JSON) & F.try_parse_json(F.col("value")).isNotNull(), "not_object"
            ).otherwise("undecodable"),
        )
        .when(~F.col("_is_edit"), "type")
        .when(F.col("_is_missing"), "missing")
        .when(F.col("ts").isNull(), "timestamp")
        .when(F.coalesce("editor", F.lit("")) == "", "editor")
        .when(F.col("namespace").isNull() | ~F.col("_well_typed"), "field_type")
    )
    derived = {
        "edit_id": F.coalesce(F.nullif("rev_id", F.lit(0)), F.nullif("_id", F.lit(0)), F.lit(0)),
        "is_anon": is_ip_strict(F.col("editor")),
        "reason": reason,
    }
    names = (
        "edit_id", "rev_id", "parent_id", "ts", "page_title", "namespace", "wiki_db", "editor",
        "is_anon", "is_bot", "is_minor", "bytes_changed", "comment", "reason",
    )
    return parts.select(*kept, "value", *[derived.get(n, F.col(n)).alias(n) for n in names])


# Name of the observed metrics with the counters below.
COUNTERS = "ingest"


def ingest_counters() -> list[Column]:
    """received, published and dropped, over the rows of ``check_envelopes``.

    Text that is no JSON never becomes an event: it is neither received nor dropped, but counted apart.
    """
    broken = F.coalesce(F.col("reason") == "undecodable", F.lit(False))
    refused = F.col("reason").isNotNull()
    return [
        F.count_if(~broken).alias("received"),
        F.count_if(~refused).alias("published"),
        F.count_if(refused & ~broken).alias("dropped"),
        F.count_if(broken).alias("undecodable"),
    ]


def count_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Checked envelopes with the counters as observed metrics.

    The metrics node also keeps filters on ``reason`` above the parsing, so each document is
    looked at once.
    """
    return check_envelopes(messages, value).observe(COUNTERS, *ingest_counters())


def validate_envelopes(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, rejected): model columns of valid edits, and refused messages with the reason."""
    checked = count_envelopes(messages, value)
    good = checked.where(F.col("reason").isNull()).drop("reason")
    rejected = checked.where(F.col("reason").isNotNull()).select("value", "reason")
    return good, rejected
