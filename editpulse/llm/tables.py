"""Input tables and small DataFrame helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.shipping import ship
from editpulse.session import new_work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; queries start here, so this also sends the package's modules to the executors."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = new_work_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def stratum(column: str) -> Column:
    """A non-null text for each value of a column: nulls make a stratum of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


def without(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows without columns that an operator is about to add (input columns of that name give way)."""
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in {n.lower() for n in names}])
