"""Staging, dimensions, facts and marts on rows worked out by hand."""

from __future__ import annotations

import datetime as dt
import hashlib

from build import at, edit, edits, navigations
from pyspark.sql import functions as F

from editpulse.functions.edits import is_revert
from editpulse.functions.keys import stable_key
from editpulse.functions.labels import severity
from editpulse.operators import dims, facts
from editpulse.operators.staging import stg_clickstream, stg_edit
from editpulse.plans import marts, serving
from editpulse.sources.calendar import build_dim_time


def star(spark, raw, clicks=None):
    staged = stg_edit(raw)
    staged_clicks = stg_clickstream(clicks if clicks is not None else navigations(spark, ("a", "b", "link", 1)))
    return facts.fact_edit(staged), dims.dim_wiki(staged, staged_clicks), dims.dim_page(staged, staged_clicks)


def test_stable_key(spark):
    def expected(text):
        return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big", signed=True)

    rows = spark.createDataFrame([("enwiki", 0, f"T{i}") for i in range(50)], "w STRING, n INT, t STRING")
    keyed = rows.select("*", stable_key(F.col("w"), F.col("n"), F.col("t")).alias("k")).collect()
    assert {r.k for r in keyed} == {expected(f"enwiki|0|{r.t}") for r in keyed}
    assert min(r.k for r in keyed) < 0 < max(r.k for r in keyed)
    assert rows.select(stable_key(F.col("w"), F.lit(None))).first()[0] is None


def test_staging(spark):
    rows = stg_edit(
        edits(
            spark,
            edit(1, user="10.1.2.3", anon=True),
            edit(2, user="10.1.2.3", anon=True, bot=True),
            edit(3, user="Ada", anon=True, comment=None),
            edit(4, comment="REVERTED 2 edits"),
            edit(5, comment="undone (undo)"),
            edit(6, comment="my_undo and éundo"),
            edit(7, title=None),
        )
    ).orderBy("edit_id").collect()
    assert [r.editor_type for r in rows] == ["anon", "bot", "anon", "user", "user", "user"]
    assert [r.ip_class_v4 for r in rows] == ["10.1.2.0/24", "10.1.2.0/24", None, None, None, None]
    assert [r.is_revert for r in rows] == [False, False, None, True, True, False]


def test_revert_words_are_whole_words(spark):
    texts = {"rollback": True, "rollbacks": False, "x:Undo.": True, "_undo_": False, "undo2": False, "": False}
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", is_revert(F.col("t")).alias("r"))
    assert {r.t: r.r for r in rows.collect()} == texts


def test_clickstream_staging_and_pages(spark):
    clicks = navigations(
        spark,
        ("other-search", "A", "external", 5), ("B", "A", "link", 3), (None, "C", "link", 1),
        ("A", None, "link", 4), ("A", "D", "link", 0),
    )
    staged = stg_clickstream(clicks)
    assert [r.referer_is_external for r in staged.orderBy("nav_count").collect()] == [None, False, True]
    pages = dims.dim_page(stg_edit(edits(spark, edit(1, title="A"), edit(2, title="A", ns=1))), staged)
    assert sorted((r.page_title, r.namespace) for r in pages.collect()) == [("A", 0), ("A", 1), ("B", 0), ("C", 0)]


def test_first_seen_observed(spark):
    staged = stg_edit(edits(spark, edit(1, 5, title="A"), edit(2, 3, title="A")))
    clicks = stg_clickstream(navigations(spark, ("A", "B", "link", 1)))
    seen = {r.page_title: r.first_seen for r in dims.dim_page(staged, clicks, first_seen="observed").collect()}
    assert seen["B"] is None and seen["A"] is not None


def test_wikis(spark):
    names = ["enwiki", "dewiktionary", "commonswiki", "frwikivoyage", "wikidatawiki"]
    staged = stg_edit(edits(spark, *[edit(i, wiki=w) for i, w in enumerate(names, 1)]))
    wikis = dims.dim_wiki(staged, stg_clickstream(navigations(spark, ("a", "b", "link", 1, "itwikinews"))))
    assert {r.wiki_id: (r.language, r.family) for r in wikis.collect()} == {
        "enwiki": ("en", "wikipedia"), "dewiktionary": ("de", "wiktionary"), "commonswiki": ("commons", "wikipedia"),
        "frwikivoyage": ("fr", "wikivoyage"), "wikidatawiki": ("wikidata", "wikipedia"), "itwikinews": ("it", "wikinews"),
    }


def test_fact_ids_and_dedupe(spark):
    raw = edits(spark, edit(1, 0), edit(1, 0, bytes_changed=99, ingested_at=at(60)), edit(2, 1))
    assert facts.fact_edit(stg_edit(raw)).count() == 3
    latest = facts.fact_edit(stg_edit(raw), dedupe="latest").orderBy("edit_id").collect()
    assert [(r.edit_id, r.bytes_changed) for r in latest] == [(1, 99), (2, 10)]
    assert latest[0].time_id == 202604011000


def test_dim_time(spark):
    rows = build_dim_time(spark)
    assert rows.count() == 525_600
    first, last = rows.orderBy("ts").first(), rows.orderBy(F.desc("ts")).first()
    assert (first.time_id, last.time_id) == (202601010000, 202612312359)
    day = build_dim_time(spark, dt.datetime(2026, 4, 5), dt.datetime(2026, 4, 5, 0, 1)).orderBy("ts").collect()
    assert [(r.day_of_week, r.is_weekend, r.hour, r.minute) for r in day] == [(0, True, 0, 0), (0, True, 0, 1)]


def test_trending(spark):
    raw = edits(
        spark,
        *[edit(i, title="A") for i in range(1, 4)],
        *[edit(i, title="B") for i in range(4, 6)],
        *[edit(i, title="C", wiki="dewiki") for i in range(6, 8)],
        edit(8, title="D"), edit(9, title="D", bot=True), edit(10, title="E", ns=1),
    )
    ranks = {r.page_title: (r.edit_count, r.rank_in_minute, r.rank_in_wiki_minute) for r in marts.trending_per_minute(*star(spark, raw)).collect()}
    assert ranks == {"A": (3, 1, 1), "B": (2, 2, 2), "C": (2, 2, 1), "D": (1, 4, 3)}


def test_velocity_counts_rows_or_minutes(spark):
    minutes = [0, *range(2, 63)]
    raw = edits(spark, *[edit(i, m) for i, m in enumerate(minutes, 1)], edit(900, 62.5))
    asis = {r.minute_bucket.minute + 60 * (r.minute_bucket.hour - 10): r for r in marts.velocity_asis(*star(spark, raw)).collect()}
    exact = {r.minute_bucket.minute + 60 * (r.minute_bucket.hour - 10): r for r in marts.velocity_60min(*star(spark, raw)).collect()}
    assert asis[61].edits_lag_60 == 1 and asis[60].edits_lag_60 is None
    assert exact[60].edits_lag_60 == 1 and exact[61].edits_lag_60 is None
    assert exact[62].edits_lag_60 == 1 and exact[62].accel == 1 and exact[61].accel == 1


def test_vandalism_windows(spark):
    anon = dict(user="10.0.0.1", anon=True)
    raw = edits(
        spark,
        edit(1, 1, **anon), edit(2, 4, **anon), edit(3, 6, user="10.0.1.9", anon=True),
        edit(4, 20, title="Q", comment="undo"), edit(5, 21, title="Q", comment=None), edit(6, 22, title="Q"), edit(7, 22, title="Q"),
        edit(8, -60 * 24 * 8, **anon), edit(9, -60 * 24 * 8, **anon), edit(10, -60 * 24 * 8, **anon),
    )
    tables = star(spark, raw)
    assert marts.vandalism_asis(*tables, as_of=at(60)).count() == 0
    sliding = marts.vandalism_sliding(*tables, as_of=at(60)).collect()
    assert [(r.page_title, r.anon_edit_count, r.distinct_ip_classes, r.revert_share) for r in sliding] == [("P", 3, 2, 0.0)]
    assert (sliding[0].window_end - sliding[0].window_start) == dt.timedelta(minutes=10)
    assert marts.vandalism_sliding_by_ip(*tables, as_of=at(60)).count() == 0


def test_vandalism_label_is_ten_minutes(spark):
    raw = edits(spark, edit(1, 6, comment="rollback"), edit(2, 7))
    (row,) = marts.vandalism_asis(*star(spark, raw), as_of=at(60)).collect()
    assert row.window_start.minute == 5 and row.window_end.minute == 15 and row.revert_share == 0.5


def test_severity(spark):
    cases = [(6, None), (0, 0.5), (4, 0.0), (3, 0.4), (3, None), (3, 0.39)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i INT, n INT, s DOUBLE")
    got = [r[0].split()[1] for r in rows.orderBy("i").select(severity(F.col("n"), F.col("s"))).collect()]
    assert got == ["high", "high", "medium", "medium", "low", "low"]


def test_anomaly_score_without_history(spark):
    raw = edits(spark, *[edit(i, 50, title="New") for i in (1, 2)], *[edit(i, 50, title="Old") for i in (3, 4)], edit(5, 50, title="Once"))
    clicks = navigations(spark, ("Old", "Old", "link", 8), ("x", "Old", "link", 2, "dewiki"))
    _, _, pages = star(spark, raw, clicks)
    history = facts.fact_clickstream(spark, stg_clickstream(clicks))
    rows = serving.anomaly_score(raw, pages, history, as_of=at(60)).collect()
    assert [(r.page_title, r.live_edits, r.navigations, r.anomaly_score) for r in rows] == [("New", 2, 0, 2.0), ("Old", 2, 10, 0.2)]


def test_trending_rollup_is_cut(spark):
    raw = edits(spark, *[edit(m, m, title="A") for m in range(1, 600)])
    trending = marts.trending_per_minute(*star(spark, raw))
    assert serving.trending_rollup_asis(trending, as_of=at(600), minutes=720).first().edit_count == 500
    assert serving.trending_rollup(trending, as_of=at(600), minutes=720).first().edit_count == 599
