"""Monthly tab-separated navigation counts."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse import schemas


def _path_exists(spark: SparkSession, path: str) -> bool:
    """Works on any file system Spark can read; no data is scanned."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def resolve_dump_path(spark: SparkSession, directory: str, lang: str, month: str) -> str:
    """The plain file if there is one (it splits), else the gzip file (it does not)."""
    base = f"{directory.rstrip('/')}/clickstream-{lang}wiki-{month}.tsv"
    for path in (base, f"{base}.gz"):
        if _path_exists(spark, path):
            return path
    raise FileNotFoundError(f"neither {base} nor {base}.gz exists")


def read_navigation_file(
    spark: SparkSession,
    path: str,
    wiki_db: str,
    dump_month: dt.date,
    quote: str | None = '"',
    spread: int | None = None,
) -> DataFrame:
    """Landing rows of one dump: positive counts with a target.

    With the default quote a field that starts with an unclosed ``"`` swallows the tabs after it
    and the row is lost; pass ``quote=""`` to keep such titles. A gzip file is read by one task,
    so its rows are spread over ``spread`` partitions (default: the shuffle width) before any
    further work.
    """
    reader = spark.read.schema(schemas.NAVIGATION).option("sep", "\t")
    if quote is not None:
        reader = reader.option("quote", quote)
    rows = reader.csv(path)
    if path.endswith(".gz"):
        rows = rows.repartition(spread or int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.where((F.col("nav_count") > 0) & F.col("target").isNotNull()).select(
        "referer",
        "target",
        "nav_type",
        "nav_count",
        F.lit(wiki_db).alias("wiki_db"),
        F.lit(dump_month).alias("dump_month"),
        F.current_timestamp().alias("ingested_at"),
    )


def read_clickstream(
    spark: SparkSession, directory: str, lang: str = "en", month: str = "2026-04", **options
) -> DataFrame:
    """Landing rows of the dump of one language and month (``YYYY-MM``)."""
    first_day = dt.date.fromisoformat(f"{month}-01")
    path = resolve_dump_path(spark, directory, lang, month)
    return read_navigation_file(spark, path, f"{lang}wiki", first_day, **options)
