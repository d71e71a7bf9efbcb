"""Publishing valid envelopes, with counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from editpulse.operators.landing import publish_cap, to_keyed_messages
from editpulse.sources.envelopes import COUNTERS, validate_envelopes
from editpulse.streaming.run import LANDING_INTERVAL, start

def publishable(messages: DataFrame, cap: int = 0) -> DataFrame:
    """(key, value) of valid envelopes; the counters ride along as observed metrics."""
    good, _ = validate_envelopes(messages)
    return publish_cap(to_keyed_messages(good), cap)


class IngestCounterListener(StreamingQueryListener):
    """Adds up the counters of all micro-batches of the session's streams."""

    def __init__(self) -> None:
        self.totals = {"received": 0, "published": 0, "dropped": 0, "undecodable": 0}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(COUNTERS)
        if row is not None:
            for name in self.totals:
                self.totals[name] += row[name] or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def publish_to_topic(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, interval: str = LANDING_INTERVAL
) -> StreamingQuery:
    """Write keyed messages to a topic; needs the Kafka connector on the class path."""
    writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    writer = writer.option("topic", topic).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval).start()


def publish_to_files(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = LANDING_INTERVAL
) -> StreamingQuery:
    """The same messages as Parquet files, readable by ``read_message_files``."""
    return start(messages, checkpoint, path=path, interval=interval)
