"""The landing job: parsed edits into the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editpulse import schemas
from editpulse.operators import bloom
from editpulse.operators.landing import enforce_landing
from editpulse.sinks.jdbc import append_jdbc
from editpulse.sinks.tables import layout_for
from editpulse.streaming.run import LANDING_INTERVAL, BatchWriter, start

_LAYOUT = layout_for("raw.stg_edit")


def _with_dates(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.expr(e) for name, e in _LAYOUT.derived.items()})


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    dates = ", ".join(f"{name} DATE" for name in _LAYOUT.partition_by)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_EDIT)
    return spark.read.schema(f"{schema}, {dates}").parquet(path)


def append_files(path: str) -> BatchWriter:
    """As is: append every non-empty micro-batch. A replayed batch lands twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            _with_dates(batch).write.mode("append").partitionBy(*_LAYOUT.partition_by).parquet(path)

    return write


def append_database(options: dict[str, str]) -> BatchWriter:
    """As is: append every non-empty micro-batch through JDBC."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            append_jdbc(batch, options)

    return write


def append_once(spark: SparkSession, path: str, quarantine: str) -> BatchWriter:
    """Land each key (edit_id, ts) once, however often and however late it arrives.

    A batch is reduced to one row per key and stripped of the keys its own edit dates already
    hold; equal keys have equal dates, so no other partition needs a look. Rows that may not land
    go to ``quarantine``, one folder per batch.
    """
    empty = spark.createDataFrame([], schemas.RAW_EDIT)
    _with_dates(empty).write.mode("ignore").partitionBy(*_LAYOUT.partition_by).parquet(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            session = batch.sparkSession
            edit_date = F.to_date("ts")
            dated = batch.where(F.col("ts").isNotNull())
            dates = [r[0] for r in dated.select(edit_date).distinct().collect()]
            # Equal keys have equal times, so row groups outside the batch's own span are not read.
            first, last = dated.agg(F.min("ts"), F.max("ts")).first()
            near = F.col("edit_date").isin(*dates) & F.col("ts").between(F.lit(first), F.lit(last)) if dates else F.lit(False)
            landed = read_landed(session, path).where(near)
            good, bad = enforce_landing(batch, landed_keys=landed)
            if dates:
                _with_dates(good).write.mode("append").partitionBy(*_LAYOUT.partition_by).parquet(path)
            if not bad.isEmpty():
                bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


# --- landing with a commit log ---------------------------------------------------------------

_COMMIT = "batch STRING, edit_date DATE, blocks INT, block INT, bits BINARY"
_BY = ("batch", "edit_date")


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it is not there yet."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(root) if f.isDirectory()) if files.exists(root) else []


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Batches that landed as a whole: those with a finished commit."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    done = lambda name: files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{name}/_SUCCESS"))
    return [name.removeprefix("batch=") for name in _folders(spark, f"{path}/commits") if done(name)]


def read_committed(spark: SparkSession, path: str, batches: list[str] | None = None) -> DataFrame:
    """Landed rows of committed batches (of these only, if given); what a batch that died has written is not read."""
    dates = ", ".join(f"{name} DATE" for name in _LAYOUT.partition_by)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_EDIT)
    wanted = committed_batches(spark, path) if batches is None else batches
    if not wanted:
        return spark.createDataFrame([], f"{schema}, batch STRING, {dates}")
    folders = [f"{path}/rows/batch={batch}" for batch in wanted]
    return spark.read.schema(f"{schema}, batch STRING, {dates}").option("basePath", f"{path}/rows").parquet(*folders)


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key_hash", F.xxhash64(*schemas.RAW_EDIT_KEY))


def _landed_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame | None:
    """Keys that may have landed already, read only where the filters of committed batches say so; None if none may."""
    commits = [f"{path}/commits/batch={batch}" for batch in committed_batches(spark, path)]
    if not commits:
        return None
    filters = spark.read.schema(_COMMIT).option("basePath", f"{path}/commits").parquet(*commits)
    asked = keys.select("edit_date", "key_hash").distinct()
    met = bloom.passing(asked, filters, _BY, ["edit_date"]).join(filters.select(*_BY).distinct(), "edit_date")
    # No more pairs than batches and dates.
    places = met.select("batch", "edit_date").distinct().collect()
    if not places:
        return None
    batches, dates = sorted({r.batch for r in places}), sorted({r.edit_date for r in places})
    return read_committed(spark, path, batches).where(F.col("edit_date").isin(*dates)).select(*schemas.RAW_EDIT_KEY)


def append_committed(path: str, quarantine: str, source: str = "edits") -> BatchWriter:
    """Land each key (edit_id, ts) once through a commit log.

    A batch is written to a folder of its own and becomes visible by its commit, written last: its edit dates, each with a
    Bloom filter of its keys. A replayed batch that is committed is skipped by its number before anything of it is read;
    one that died half-way is written over. Keys are compared with landed rows only on dates and in batches whose filters may hold
    one of them, so a batch of new edits reads filters alone. ``source`` names the query; two queries that
    share a folder need different names, and must not run at the same time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"{source}-{batch_id}"
        session = batch.sparkSession
        if name in committed_batches(session, path):
            return
        batch.persist()
        try:
            keys = _keyed(_with_dates(batch.where(F.col("ts").isNotNull())))
            good, bad = enforce_landing(batch, landed_keys=_landed_keys(session, path, keys))
            rows = f"{path}/rows/batch={name}"
            _with_dates(good).write.mode("overwrite").partitionBy(*_LAYOUT.partition_by).parquet(rows)
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={name}")
            landed = _keyed(read_committed(session, path, [name])).select(*_BY, "key_hash")
            filters = bloom.filters_of(landed.distinct(), _BY)
            filters.drop("batch").write.mode("overwrite").parquet(f"{path}/commits/batch={name}")
        finally:
            batch.unpersist()

    return write


def land_edits(
    parsed: DataFrame, write_batch: BatchWriter, checkpoint: str, interval: str | None = LANDING_INTERVAL
) -> StreamingQuery:
    """Start landing with one of the batch writers above."""
    return start(parsed, checkpoint, write_batch=write_batch, interval=interval)
