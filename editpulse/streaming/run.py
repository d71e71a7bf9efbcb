"""Starting and finishing streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: how often the landing job runs a micro-batch.
LANDING_INTERVAL = "10 seconds"

BatchWriter = Callable[[DataFrame, int], None]


def start(
    rows: DataFrame,
    checkpoint: str,
    path: str | None = None,
    write_batch: BatchWriter | None = None,
    interval: str | None = LANDING_INTERVAL,
) -> StreamingQuery:
    """Append ``rows`` to Parquet files at ``path`` or through ``write_batch``.

    ``interval=None`` takes everything available now, in as many micro-batches as the source's
    intake bound asks for, and stops.
    """
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    if write_batch:
        return writer.foreachBatch(write_batch).start()
    return writer.format("parquet").option("path", path).start()


def finish(query: StreamingQuery, timeout_s: int = 1800) -> StreamingQuery:
    """Wait for an available-now query; raises its error if it failed or ran out of time."""
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout_s} s")
    return query


def numbered_batches(path: str, prepare: Callable[[DataFrame], DataFrame]) -> BatchWriter:
    """Write each prepared micro-batch to its own folder, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                prepare(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write
