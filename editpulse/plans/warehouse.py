"""The stored warehouse: which relation is built from which, and where it is kept."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from editpulse.operators import dims, facts, staging
from editpulse.operators.filters import AsOf
from editpulse.operators.upsert import load_incrementally
from editpulse.plans import marts
from editpulse.plans.descriptions import describe_table, described
from editpulse.plans.refresh import refresh_clickstream, refresh_mart
from editpulse.sinks.tables import arrange, create_namespaces, layout_for, materialize_table, seed_if_absent
from editpulse.sources.calendar import build_dim_time, dim_time_covering
from editpulse.sources.lookups import table_exists

RAW = ("raw.stg_edit", "raw.stg_clickstream")
DIMS = ("core.dim_wiki", "core.dim_page", "core.dim_editor")
FACTS = ("core.fact_edit", "core.fact_clickstream")
MARTS = ("marts.trending_per_minute", "marts.edit_velocity", "marts.vandalism_candidates")
ALL = (*RAW, "core.dim_time", *DIMS, *FACTS, *MARTS)


class _Relations:
    """Named relations and how each one is derived from others."""

    spark: SparkSession
    as_of: AsOf

    def table(self, name: str) -> DataFrame:
        raise NotImplementedError

    def stg_edit(self) -> DataFrame:
        return staging.stg_edit(self.table("raw.stg_edit"))

    def stg_clickstream(self) -> DataFrame:
        return staging.stg_clickstream(self.table("raw.stg_clickstream"))

    def star(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.table("core.fact_edit"), self.table("core.dim_wiki"), self.table("core.dim_page")

    def derive(self, name: str) -> DataFrame:
        recipes: dict[str, Callable[[], DataFrame]] = {
            "core.dim_wiki": lambda: dims.dim_wiki(self.stg_edit(), self.stg_clickstream()),
            "core.dim_page": lambda: dims.dim_page(self.stg_edit(), self.stg_clickstream()),
            "core.dim_editor": lambda: dims.dim_editor(self.stg_edit()),
            "core.fact_edit": lambda: facts.fact_edit(self.stg_edit()),
            "core.fact_clickstream": lambda: facts.fact_clickstream(self.spark, self.stg_clickstream()),
            "marts.trending_per_minute": lambda: marts.trending_per_minute(*self.star()),
            "marts.edit_velocity": lambda: marts.velocity_asis(*self.star()),
            "marts.vandalism_candidates": lambda: marts.vandalism_asis(*self.star(), as_of=self.as_of),
        }
        return recipes[name]()


class CatalogWarehouse(_Relations):
    """Relations kept as catalog tables in the raw, core and marts namespaces."""

    def __init__(self, spark: SparkSession, as_of: AsOf = None, location: str | None = None, prefix: str = ""):
        self.spark, self.as_of, self.prefix = spark, as_of, prefix
        create_namespaces(spark, location, prefix)

    def name(self, relation: str) -> str:
        return f"{self.prefix}{relation}"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.name(name))

    def find(self, name: str) -> DataFrame | None:
        return self.table(name) if table_exists(self.spark, self.name(name)) else None

    def store(self, name: str, rows: DataFrame) -> None:
        materialize_table(rows, self.name(name), layout_for(name), described)
        describe_table(self.spark, name, self.name(name))

    def build(self, full_refresh: bool = False) -> dict[str, set | None]:
        """Dimensions are rebuilt; the edit fact takes what landed since the last build, and marts and the navigation
        fact recompute what that changed. Gives the dates or months written per refreshed relation (None: all).
        """
        # The usual year, and whatever minutes the edits reach beyond it.
        for minutes in (build_dim_time(self.spark), dim_time_covering(self.table("raw.stg_edit"))):
            seed_if_absent(self.spark, described(minutes), self.name("core.dim_time"), "time_id")
        describe_table(self.spark, "core.dim_time", self.name("core.dim_time"))
        for name in DIMS:
            self.store(name, self.derive(name))
        whole = full_refresh or self.find("core.fact_edit") is None
        fact = self.name("core.fact_edit")
        if whole:
            self.store("core.fact_edit", self.derive("core.fact_edit"))
        else:
            load_incrementally(
                self.spark,
                fact,
                self.table("raw.stg_edit"),
                lambda landed: facts.fact_edit(staging.stg_edit(landed)),
                sort_by=layout_for("core.fact_edit").sort_by,
                indexed=True,
                logged=True,
            )
        clicks = self.name("core.fact_clickstream")
        written = {"core.fact_clickstream": refresh_clickstream(self.spark, clicks, self.table("raw.stg_clickstream"), staging.stg_clickstream, whole)}
        for name in MARTS:
            written[name] = refresh_mart(self.spark, self.name(name), name, fact, *self.star()[1:], as_of=self.as_of, whole=whole)
        for name in (n for n, dates in written.items() if dates is None):
            describe_table(self.spark, name, self.name(name))
        return written


class FolderWarehouse(_Relations):
    """Relations kept as Parquet folders, each written the first time it is asked for.

    ``sources`` gives the landing relations (and any other input worth keeping) by name.
    """

    def __init__(
        self, spark: SparkSession, root: str, sources: Mapping[str, Callable[[], DataFrame]], as_of: AsOf = None
    ):
        self.spark, self.root, self.as_of = spark, root, as_of
        self._sources = sources
        self._stored: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def derive(self, name: str) -> DataFrame:
        if name in self._sources:
            return self._sources[name]()
        if name == "core.dim_time":
            return dim_time_covering(self.table("raw.stg_edit"))
        return super().derive(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._stored:
            layout = layout_for(name)
            rows = arrange(self.derive(name), layout)
            writer = rows.write.mode("overwrite").options(**layout.options())
            if layout.partition_by:
                writer = writer.partitionBy(*layout.partition_by)
            writer.parquet(self.path(name))
            self._stored[name] = self.spark.read.schema(rows.schema).parquet(self.path(name))
        return self._stored[name]

    def build(self) -> None:
        for name in ALL:
            self.table(name)


def relations(warehouse: CatalogWarehouse | FolderWarehouse) -> dict[str, DataFrame]:
    return {name: warehouse.table(name) for name in ALL}
