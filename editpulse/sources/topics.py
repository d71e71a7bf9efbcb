"""Message streams, from a topic or from files with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse import schemas

# Nothing is skipped: from the first message on, and a gap in the offsets stops the stream.
TOPIC_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}

# The topic as the described landing job reads it. It starts at the newest message,
# passes over lost offsets and takes at most 5000 messages per trigger.
TOPIC_ASIS = {
    "startingOffsets": "latest",
    "failOnDataLoss": "false",
    "maxOffsetsPerTrigger": "5000",
}


def topic_options(servers: str, topic: str, **overrides: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **TOPIC_DEFAULTS, **overrides}


def read_topic(spark: SparkSession, servers: str, topic: str, **overrides: str) -> DataFrame:
    """Streaming (key, value, ...) rows; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka")
    return reader.options(**topic_options(servers, topic, **overrides)).load()


def read_message_files(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """The same stream from files: parquet with key/value columns, or one JSON document per text line.

    ``files_per_trigger`` is the intake bound; None takes whatever has arrived.
    """
    reader = spark.readStream.format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "text":
        lines = reader.load(path)
        return lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    return reader.schema(schemas.MESSAGE).load(path)


def read_edit_stream(spark: SparkSession, fmt: str = "kafka", **source) -> DataFrame:
    """Edit messages by source format; ``source`` goes to the reader for that format."""
    if fmt == "kafka":
        return read_topic(spark, **source)
    return read_message_files(spark, fmt=fmt, **source)


def decode_json(value: Column, schema: T.StructType) -> Column:
    """Bytes or text to a struct. Bad text gives NULL fields; a wrong-typed field is NULL on its own."""
    return F.from_json(value.cast("string"), schema)


def parse_marks(messages: DataFrame) -> DataFrame:
    return messages.select(decode_json(F.col("value"), schemas.MARKS).alias("m")).select("m.*")
