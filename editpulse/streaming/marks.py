"""Average marks of a student stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editpulse.functions.labels import marks_average
from editpulse.sources.topics import parse_marks


def with_average(messages: DataFrame) -> DataFrame:
    """name, math, physics and their average; batch or stream."""
    return parse_marks(messages).withColumn("average", marks_average(F.col("math"), F.col("physics")))


def show_averages(messages: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
    """Print each micro-batch on the console."""
    writer = with_average(messages).writeStream.outputMode("append").format("console")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.start()
