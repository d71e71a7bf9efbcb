"""URL filters over dated lists: validity intervals and an as-of join at fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Captures of one host are dealt to this many parts; each list interval is repeated as often.
SALTS = 32
_URL = r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)"
LONGEST_HOST = 253
FOREVER = "9999-12-31 00:00:00"


def host_of(url: str) -> Column:
    """Lower-case host without user, port and final dot; '' if there is none, or if it is longer than a host can be."""
    host = F.rtrim(F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _URL, 1)), F.lit("."))
    return F.when(F.length(host) <= LONGEST_HOST, host).otherwise("")


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _URL, 2)


def list_intervals(events: DataFrame) -> DataFrame:
    """Dated list entries (list, entry, action 'add' or 'remove', at) as intervals [valid_from, valid_to).

    An entry is a host ('example.com', with all below it) or a host and a first path segment
    ('example.com/forum'). Adding what is listed and removing what is not change nothing; of several
    events at one time the removal counts last. Rows with a null in any of the four columns, or another
    action, are no events. Open intervals end in the year 9999.

    The state after an event is its own action, so only its neighbour is looked at: one shuffle by
    (list, entry), after equal events are merged.
    """
    valid = events.where(
        F.col("list").isNotNull() & F.col("entry").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove")
    )
    merged = valid.groupBy("list", "entry", "at").agg(F.max(F.col("action") == "remove").alias("_removed"))
    along = Window.partitionBy("list", "entry").orderBy("at")
    turns = merged.withColumn("_was", F.lag("_removed", 1, True).over(along)).where("_removed != _was")
    until = F.coalesce(F.lead("at").over(along), F.lit(FOREVER).cast("timestamp_ntz"))
    return turns.withColumn("valid_to", until).where("not _removed").select(
        "list", "entry", F.col("at").alias("valid_from"), "valid_to"
    )


def _entries(host: Column, path: Column) -> Column:
    """All entries a URL could be under: each suffix of its host, alone and with the first path segment."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    segment = F.regexp_extract(path, r"^/([^/]+)", 1)
    below = F.transform(suffixes, lambda s: F.concat(s, F.lit("/"), segment))
    return F.when(host == "", F.array().cast("array<string>")).when(segment == "", suffixes).otherwise(F.concat(suffixes, below))


def asof_filter(captures: DataFrame, intervals: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every distinct capture (page_id, url, fetch_time) with the list entries active when it was fetched.

    Adds host, copies (equal rows), n_active, lists (sorted names), first_entry (the earliest listed, then
    by name) and blocked. Captures without a host (of at most 253 characters) or fetch time match nothing and stay.

    A capture is exploded to its few possible entries and joined on (entry, salt) with
    valid_from <= fetch_time < valid_to: intervals of one entry on one list never overlap, so a
    capture meets one row per list and entry at most. The salt splits hosts with many captures;
    Spark broadcasts the intervals instead where their size allows. Matches are summed per capture
    before anything else is joined.
    """
    distinct = captures.groupBy("page_id", "url", "fetch_time").agg(F.count(F.lit(1)).alias("copies"))
    keys = ["page_id", "url", "fetch_time"]
    salt = F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int")
    candidates = distinct.withColumn("host", host_of("url")).withColumn("_salt", salt)
    exploded = candidates.withColumn("entry", F.explode_outer(_entries(F.col("host"), path_of("url"))))
    repeated = intervals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    active = (F.col("fetch_time") >= F.col("valid_from")) & (F.col("fetch_time") < F.col("valid_to"))
    met = exploded.alias("c").join(
        repeated.alias("i"), (F.col("c.entry") == F.col("i.entry")) & (F.col("c._salt") == F.col("i._salt")) & active, "left"
    )
    found = F.when(F.col("i.list").isNotNull(), F.struct("valid_from", F.col("i.entry").alias("entry")))
    summed = met.groupBy(*keys, "host", "copies").agg(
        F.count("i.list").alias("n_active"),
        F.array_join(F.array_sort(F.collect_set("i.list")), ",").alias("lists"),
        F.min(found).alias("_first"),
    )
    return summed.select(
        *keys, "host", "copies", "n_active", "lists", F.col("_first.entry").alias("first_entry"), (F.col("n_active") > 0).alias("blocked")
    )
