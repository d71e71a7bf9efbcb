"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


# Times are UTC everywhere. The JVM never compiles a generated method over 8000 bytes of bytecode to
# machine code, so wide projections (JSON envelopes) run faster as several small methods. The default kind of
# timestamp in Parquet has no minimum and maximum, so row groups could not be skipped by time.
RUNTIME_CONF = {
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "editpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings, AQE and disk-backed streaming state."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.ui.enabled", "false")
                .config("spark.driver.host", "127.0.0.1")
                .config("spark.driver.bindAddress", "127.0.0.1")
            )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local[..] session without the setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="editpulse-")
    return _local_roots[app]


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other run uses; Spark creates it on first write."""
    return f"{shared_root(spark)}/editpulse/{purpose}-{uuid.uuid4().hex}"
