"""Streams give what batches give, over several files and replays."""

from __future__ import annotations

import json

import pytest
from build import at, edit, edits
from pyspark.sql import functions as F

from editpulse.operators.landing import publish_cap
from editpulse.plans import marts
from editpulse.sources.envelopes import parse_envelope
from editpulse.sources.topics import read_edit_stream
from editpulse.streaming import landing, live, publish
from editpulse.streaming import marks as marks_stream
from editpulse.streaming import marts as stream_marts
from editpulse.streaming.run import finish, numbered_batches, start
from test_star import star


def slices(spark, work_dir, *parts):
    """Landing rows in several files; returns a stream that takes one file at a time."""
    for part in parts:
        edits(spark, *part).coalesce(1).write.mode("append").parquet(f"{work_dir}/in")
    schema = spark.read.parquet(f"{work_dir}/in").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{work_dir}/in")


def run_to_files(spark, rows, work_dir):
    finish(start(rows, f"{work_dir}/checkpoint", path=f"{work_dir}/out", interval=None))
    return spark.read.schema(rows.schema).parquet(f"{work_dir}/out")


def sample_rows():
    rows, n = [], 0
    for minute in range(0, 40):
        for k in range(1 + minute % 3):
            n += 1
            anon = (minute + k) % 2 == 0
            rows.append(
                edit(n, minute + k / 10, title=f"P{k % 2}", user=f"10.0.{minute % 3}.{k}" if anon else "U", anon=anon,
                     bot=n % 7 == 0, comment="undo" if n % 5 == 0 else None)
            )
    return rows


def test_sliding_windows_equal_batch(spark, work_dir):
    rows = sample_rows()
    stream = stream_marts.vandalism_windows(slices(spark, work_dir, rows[:20], rows[20:45], rows[45:]))
    got = run_to_files(spark, stream, work_dir)
    raw = edits(spark, *rows)
    closed_by = raw.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    batch = marts.vandalism_sliding(*star(spark, raw), as_of=at(60)).where(F.col("window_end") <= F.lit(closed_by))
    columns = ["window_start", "page_id", "anon_edit_count", "total_edit_count", "distinct_ip_classes", "revert_share"]
    assert batch.count() > 3
    assert sorted(got.select(*columns).collect()) == sorted(batch.select(*columns).collect())


def test_trending_equals_batch(spark, work_dir):
    rows = sample_rows()
    counts = stream_marts.minute_counts(slices(spark, work_dir, rows[:30], rows[30:]))
    write = numbered_batches(f"{work_dir}/ranked", stream_marts.rank_closed_minutes)
    finish(start(counts, f"{work_dir}/checkpoint", write_batch=write, interval=None))
    got = spark.read.parquet(f"{work_dir}/ranked")
    last = got.agg(F.max("minute_bucket")).first()[0]
    batch = marts.trending_per_minute(*star(spark, edits(spark, *rows))).where(F.col("minute_bucket") <= F.lit(last))
    columns = ["minute_bucket", "page_id", "edit_count", "rank_in_minute", "rank_in_wiki_minute"]
    assert got.count() > 20
    assert sorted(got.select(*columns).collect()) == sorted(batch.select(*columns).collect())


def test_running_ranks_and_late_edits(spark, work_dir):
    """Open minutes are ranked as they fill, late edits correct closed ones, a batch that died is written over."""
    rows = sample_rows()
    late = [edit(900 + k, 3 + k / 10, title="P1", user="U") for k in range(3)]
    path = f"{work_dir}/live"
    columns = ["minute_bucket", "page_id", "edit_count", "rank_in_minute", "rank_in_wiki_minute"]

    def expected(part):
        batch = marts.trending_per_minute(*star(spark, edits(spark, *part)))
        return sorted(batch.select(*columns).collect())

    def found():
        return sorted(live.read_live(spark, path).select(*columns).collect())

    assert found() == []
    write = live.live_trending(path, delay_seconds=600)
    write(edits(spark, *rows[:30]), 0)
    assert found() == expected(rows[:30])
    write(edits(spark, *rows[30:]), 1)
    assert found() == expected(rows)
    assert live.read_late(spark, path).count() == 0
    closed = {r.minute_bucket for r in live.read_live(spark, path).where("closed").collect()}
    assert 20 < len(closed) < 40
    write(edits(spark, *late), 1)
    assert found() == expected(rows)
    write(edits(spark, *late), 2)
    assert found() == expected([*rows, *late])
    assert live.read_late(spark, path).agg(F.sum("edit_count")).first()[0] == 3
    # Rows without a commit are not read.
    live.rank_minutes(live.read_live(spark, path).select("minute_bucket", "wiki_id", "page_id", "page_title", "edit_count")).limit(1).withColumn("slot", F.lit(1).cast("bigint")).write.parquet(f"{path}/minutes/batch=3")
    assert found() == expected([*rows, *late])
    write(edits(spark, edit(950, 70)), 3)
    write(edits(spark, edit(951, 70, bot=True)), 4)
    assert found() == expected([*rows, *late, edit(950, 70)])


def envelopes(spark, work_dir, *events):
    rows = [(json.dumps(e),) for e in events]
    spark.createDataFrame(rows, "value STRING").coalesce(1).write.mode("append").text(f"{work_dir}/topic")


def event(i, user="U", second=0, **more):
    return {
        "type": "edit", "id": i, "namespace": 0, "title": "T", "timestamp": 1775037600 + second, "user": user,
        "wiki": "enwiki", "revision": {"old": i - 1, "new": i}, "length": {"old": 1, "new": 2}, **more,
    }


def land_once(spark, work_dir, run):
    parsed = parse_envelope(read_edit_stream(spark, fmt="text", path=f"{work_dir}/topic", files_per_trigger=1))
    write = landing.append_once(spark, f"{work_dir}/rows", f"{work_dir}/quarantine-{run}")
    finish(landing.land_edits(parsed, write, f"{work_dir}/checkpoint-{run}", interval=None))
    return landing.read_landed(spark, f"{work_dir}/rows")


def test_landing_once(spark, work_dir):
    late = 5 * 24 * 3600
    envelopes(spark, work_dir, event(1), event(2), event(1), event(9, user=None))
    envelopes(spark, work_dir, event(2), event(3, second=late), event(4, type="log"))
    envelopes(spark, work_dir, event(1), event(1, second=late))
    assert sorted(r.edit_id for r in land_once(spark, work_dir, 1).collect()) == [1, 1, 2, 3]
    assert [r.edit_id for r in spark.read.parquet(f"{work_dir}/quarantine-1").collect()] == [9]
    # The same messages again, from the start, add nothing.
    assert land_once(spark, work_dir, 2).count() == 4


def test_replayed_batch_lands_once(spark, work_dir):
    batch = edits(spark, edit(1), edit(2, 1))
    write = landing.append_once(spark, f"{work_dir}/rows", f"{work_dir}/quarantine")
    write(batch, 0)
    write(batch, 0)
    write(batch.where("false"), 1)
    assert landing.read_landed(spark, f"{work_dir}/rows").count() == 2


def test_plain_landing_appends(spark, work_dir):
    write = landing.append_files(f"{work_dir}/rows")
    for batch_id in (0, 0, 1):
        write(edits(spark, edit(1)) if batch_id == 0 else edits(spark, edit(1)).where("false"), batch_id)
    assert landing.read_landed(spark, f"{work_dir}/rows").count() == 2


def test_publish_counts_and_reads_back(spark, work_dir):
    envelopes(spark, work_dir, event(1), event(2, type="log"), event(3, user=" "))
    envelopes(spark, work_dir, event(4))
    spark.createDataFrame([("no json",)], "value STRING").write.mode("append").text(f"{work_dir}/topic")
    listener = publish.IngestCounterListener()
    spark.streams.addListener(listener)
    try:
        keyed = publish.publishable(read_edit_stream(spark, fmt="text", path=f"{work_dir}/topic"))
        finish(publish.publish_to_files(keyed, f"{work_dir}/out", f"{work_dir}/checkpoint", interval=None))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals == {"received": 4, "published": 2, "dropped": 2, "undecodable": 1}
    sent = parse_envelope(spark.read.parquet(f"{work_dir}/out")).collect()
    assert sorted(r.edit_id for r in sent) == [1, 4]


def test_marks(spark, work_dir):
    rows = [('{"name": "Ines", "math": 31, "physics": 44}',), ('{"name": "Oka", "math": 90, "physics": 7}',)]
    spark.createDataFrame(rows, "value STRING").write.text(f"{work_dir}/marks")
    stream = read_edit_stream(spark, fmt="text", path=f"{work_dir}/marks")
    query = marks_stream.with_average(stream).writeStream.format("memory").queryName("averages")
    finish(query.trigger(availableNow=True).start())
    assert sorted(tuple(r) for r in spark.table("averages").collect()) == [("Ines", 31, 44, 37.5), ("Oka", 90, 7, 48.5)]
    console = marks_stream.show_averages(stream, f"{work_dir}/console")
    console.processAllAvailable()
    console.stop()


def test_capped_stream(spark, work_dir):
    rows = slices(spark, work_dir, [edit(i) for i in range(1, 11)], [edit(i) for i in range(11, 21)])
    assert run_to_files(spark, publish_cap(rows, 13), work_dir).count() == 13




def test_landing_by_commits(spark, work_dir, monkeypatch):
    """Replays are skipped, half-written batches are not read and written over, new edits read no landed rows."""
    path, day = f"{work_dir}/landed", 24 * 60
    write = landing.append_committed(path, f"{work_dir}/quarantine")
    ids = lambda: sorted(r.edit_id for r in landing.read_committed(spark, path).collect())
    assert ids() == [] and landing.committed_batches(spark, path) == []
    first = edits(spark, edit(1), edit(1), edit(2, day), edit(3, day, editor=None))
    write(first, 0)
    assert ids() == [1, 2] and spark.read.parquet(f"{work_dir}/quarantine/batch=edits-0").count() == 1
    files = set(landing.read_committed(spark, path).inputFiles())
    write(edits(spark, edit(9)), 0)
    assert ids() == [1, 2] and files == set(landing.read_committed(spark, path).inputFiles())
    # The second batch dies between its rows and its commit.
    with monkeypatch.context() as broken:
        broken.setattr(landing.bloom, "filters_of", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write(edits(spark, edit(4), edit(2, day)), 1)
    assert ids() == [1, 2] and landing.committed_batches(spark, path) == ["edits-0"]
    write(edits(spark, edit(4), edit(2, day), edit(5, 2 * day)), 1)
    assert ids() == [1, 2, 4, 5]
    # Another query sends the same and a new edit; an edit of another time is another key.
    landing.append_committed(path, f"{work_dir}/quarantine", source="again")(edits(spark, edit(1), edit(2, day), edit(6, 3 * day), edit(1, 5)), 0)
    assert ids() == [1, 1, 2, 4, 5, 6]
    keys = landing._keyed(landing._with_dates(edits(spark, edit(100, 9), edit(101, day + 9), edit(102, 9 * day))))
    found = landing._landed_keys(spark, path, keys)
    assert found is None or len(found.inputFiles()) <= 1
