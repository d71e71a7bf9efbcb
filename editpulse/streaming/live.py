"""Running ranks of minutes: open minutes as they fill, closed ones corrected when late edits arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.plans.marts import rank_minutes
from editpulse.streaming.marts import watermarked_articles
from editpulse.streaming.run import BatchWriter

# Minutes are replaced by slots of so many seconds: what a batch rewrites at least.
SLOT_SECONDS = 600
DELAY_SECONDS = 600
_KEYS = ("minute_bucket", "wiki_id", "page_id", "page_title")
_RANKED = (
    "minute_bucket TIMESTAMP, wiki_id STRING, page_id BIGINT, page_title STRING, edit_count BIGINT, "
    "rank_in_minute BIGINT, rank_in_wiki_minute BIGINT, slot BIGINT, batch BIGINT"
)
_COMMIT = "slot BIGINT, version BIGINT, watermark BIGINT, batch BIGINT"


def _slot() -> Column:
    return F.expr(f"unix_seconds(minute_bucket) div {SLOT_SECONDS}")


def _last_commit(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The newest finished commit (below ``before``)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    names = [f.getPath().getName() for f in files.listStatus(root) if f.getPath().getName().startswith("batch=")]
    numbers = sorted((int(n.removeprefix("batch=")) for n in names), reverse=True)
    done = lambda n: files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/commits/batch={n}/_SUCCESS"))
    return next((n for n in numbers if (before is None or n < before) and done(n)), None)


def _commit(spark: SparkSession, path: str, number: int) -> DataFrame:
    """slot, version (the batch that wrote its rows) and the watermark in seconds, for all slots so far."""
    return spark.read.schema(_COMMIT).option("basePath", f"{path}/commits").parquet(f"{path}/commits/batch={number}").drop("batch")


def _versions(spark: SparkSession, path: str, commit: DataFrame, slots: list[int] | None = None) -> DataFrame:
    """The ranked rows a commit stands for; only of some slots if given."""
    wanted = commit.where(F.col("slot").isNotNull())
    if slots is not None:
        wanted = wanted.where(F.col("slot").isin(*slots))
    numbers = sorted(r[0] for r in wanted.select("version").distinct().collect())
    if not numbers:
        return spark.createDataFrame([], _RANKED).drop("batch")
    folders = [f"{path}/minutes/batch={n}" for n in numbers]
    rows = spark.read.schema(_RANKED).option("basePath", f"{path}/minutes").parquet(*folders)
    pairs = wanted.select("slot", F.col("version").alias("batch"))
    return rows.join(pairs, ["slot", "batch"]).drop("batch")


def live_trending(path: str, delay_seconds: int = DELAY_SECONDS) -> BatchWriter:
    """Keep the ranks of all minutes under ``path`` up to date with every batch of landing rows.

    The counts of the slots a batch has edits for are added to the stored ones, ranked anew and written under the batch's number;
    the commit, written last, names the newest version of every slot and the watermark. So an open minute has running ranks,
    the last update of a minute is what a batch job gives, and no edit is lost: edits of minutes that were closed (the
    watermark, so far behind the newest edit, has passed their end) correct them, and are counted under ``late``. A replayed batch that
    is committed is skipped; one that died is written over. Versions that no commit names may be removed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = _last_commit(spark, path)
        if last is not None and last >= batch_id:
            return
        people = watermarked_articles(batch).where(~F.col("is_bot") & F.col("ts").isNotNull())
        people = people.select(F.date_trunc("minute", "ts").alias("minute_bucket"), *_KEYS[1:], F.unix_seconds("ts").alias("_second"))
        counts = people.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("edit_count"), F.max("_second").alias("_newest"))
        counts = counts.withColumn("slot", _slot()).persist()
        try:
            seen = counts.groupBy("slot").agg(F.max("_newest").alias("newest")).collect()
            commit = _commit(spark, path, last) if last is not None else spark.createDataFrame([], _COMMIT).drop("batch")
            watermark = commit.agg(F.max("watermark")).first()[0]
            slots = [r.slot for r in seen]
            old = _versions(spark, path, commit, slots).select(*_KEYS, "edit_count", "slot")
            whole = old.unionByName(counts.drop("_newest")).groupBy(*_KEYS, "slot").agg(F.sum("edit_count").alias("edit_count"))
            ranked = rank_minutes(whole.drop("slot")).withColumn("slot", _slot())
            ranked.sortWithinPartitions("slot").write.mode("overwrite").parquet(f"{path}/minutes/batch={batch_id}")
            closed = F.unix_seconds("minute_bucket") + 60 <= F.lit(watermark)
            late = counts.where(F.coalesce(closed, F.lit(False))).drop("_newest", "slot")
            late.write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            newest = max([r.newest - delay_seconds for r in seen] + ([watermark] if watermark is not None else []), default=None)
            new = spark.createDataFrame([(s, batch_id) for s in slots] or [(None, batch_id)], "slot BIGINT, version BIGINT")
            kept = commit.select("slot", "version").join(new.select("slot"), "slot", "left_anti")
            both = kept.unionByName(new).withColumn("watermark", F.lit(newest).cast("bigint"))
            both.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch={batch_id}")
        finally:
            counts.unpersist()

    return write


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """Newest ranks of all minutes, and whether the minute is closed."""
    last = _last_commit(spark, path)
    if last is None:
        return spark.createDataFrame([], _RANKED).drop("batch", "slot").withColumn("closed", F.lit(False))
    commit = _commit(spark, path, last)
    watermark = commit.agg(F.max("watermark")).first()[0]
    closed = F.coalesce(F.unix_seconds("minute_bucket") + 60 <= F.lit(watermark), F.lit(False))
    return _versions(spark, path, commit).drop("slot").withColumn("closed", closed)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Edits that came after their minute was closed: batch, minute, page and how many."""
    schema = "minute_bucket TIMESTAMP, wiki_id STRING, page_id BIGINT, page_title STRING, edit_count BIGINT, batch BIGINT"
    return spark.read.schema(schema).option("basePath", f"{path}/late").parquet(f"{path}/late")
