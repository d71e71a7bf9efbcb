"""Rules of the landing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse import schemas
from editpulse.operators.numbering import first_per_key


def _missing(required: Sequence[str]) -> Column:
    """Name of the first required column that is NULL, else NULL."""
    return F.coalesce(*[F.when(F.col(c).isNull(), c) for c in required])


def enforce_landing(
    rows: DataFrame,
    key: Sequence[str] = schemas.RAW_EDIT_KEY,
    required: Sequence[str] = schemas.RAW_EDIT_REQUIRED,
    landed_keys: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): rows fit for the landing table, and rows with a NULL where none may be.

    Of rows with the same key the earliest ingested stays; keys that already landed are left out,
    so landing the same rows again adds nothing.
    """
    missing = _missing(required)
    good = first_per_key(rows.where(missing.isNull()), key, ["ingested_at"])
    if landed_keys is not None:
        good = good.join(landed_keys.select(*key).distinct(), list(key), "left_anti").select(*rows.columns)
    quarantine = rows.where(missing.isNotNull()).withColumn("missing_column", missing)
    return good, quarantine


def to_keyed_messages(valid: DataFrame) -> DataFrame:
    """(key, value) for a topic: key ``wiki:title``, value the original JSON untouched."""
    return valid.select(
        F.concat_ws(":", "wiki_db", "page_title").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
    )


def publish_cap(rows: DataFrame, n: int) -> DataFrame:
    """At most n rows; 0 means no cap. Works on append streams too."""
    return rows.limit(n) if n > 0 else rows
