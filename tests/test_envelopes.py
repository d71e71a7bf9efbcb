"""Envelope parsing and validation, including where the two differ."""

from __future__ import annotations

import datetime as dt
import ipaddress
import json

import pytest
from pyspark.sql import functions as F

from editpulse.functions.network import is_ip_strict, looks_like_ip_loose
from editpulse.operators.landing import enforce_landing, publish_cap, to_keyed_messages
from editpulse.sources.envelopes import check_envelopes, parse_envelope, replay_envelopes, validate_envelopes

BASE = {
    "id": 88017, "type": "edit", "namespace": 0, "title": "Lighthouse", "comment": "add height",
    "timestamp": 1775037600, "user": "Marlow", "bot": False, "minor": False, "wiki": "enwiki",
    "revision": {"old": 740, "new": 752}, "length": {"old": 910, "new": 1033},
}
SENT = dt.datetime(2026, 4, 1, 10, 0)


def messages(spark, *events):
    rows = [(i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "n INT, value STRING")


def changed(**fields):
    return {k: v for k, v in {**BASE, **fields}.items() if v is not ...}


def checked(spark, *events):
    rows = check_envelopes(messages(spark, *events))
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return sorted(rows.collect(), key=lambda r: r.n)


def test_plain_edit(spark):
    (row,) = checked(spark, BASE)
    assert row.reason is None
    assert (row.edit_id, row.rev_id, row.parent_id, row.bytes_changed, row.ts) == (752, 752, 740, 123, SENT)
    assert (row.page_title, row.wiki_db, row.editor) == ("Lighthouse", "enwiki", "Marlow")
    assert not (row.is_anon or row.is_bot or row.is_minor)


@pytest.mark.parametrize(
    ("event", "reason"),
    [
        (changed(type="log"), "type"),
        (changed(type="categorize"), "type"),
        (changed(type=...), "type"),
        (changed(title=None), "missing"),
        (changed(namespace=None), "missing"),
        (changed(timestamp=None), "timestamp"),
        (changed(timestamp="soon"), "timestamp"),
        (changed(timestamp=10**15), "timestamp"),
        (changed(user=""), "editor"),
        (changed(user=None), "editor"),
        (changed(user=" \t  "), "editor"),
        (changed(namespace="none"), "field_type"),
        (changed(title=5), "field_type"),
        (changed(comment=["a"]), "field_type"),
        (changed(wiki=7), "field_type"),
        (changed(revision=5), "field_type"),
        (changed(revision={"old": 1, "new": "x"}), "field_type"),
        ("{bad", "undecodable"),
        ("[1, 2]", "not_object"),
        ('{"type": "edit"} and more', "undecodable"),
        ("", "undecodable"),
    ],
)
def test_refused(spark, event, reason):
    assert [r.reason for r in checked(spark, event)] == [reason]


def test_accepted_oddities(spark):
    rows = checked(
        spark,
        changed(user="192.168.0.1"),
        changed(user="Ines"),
        changed(user="Tidy", bot=True),
        changed(length=...),
        changed(length={}),
        changed(length={"old": None, "new": None}),
        changed(revision=...),
        changed(revision={"old": 3, "new": 0}),
        changed(wiki=None),
        changed(user="  Padded "),
        changed(timestamp="1775037600"),
        changed(title="2024"),
        changed(title="[draft]"),
    )
    assert [r.reason for r in rows] == [None] * len(rows)
    assert [r.is_anon for r in rows[:2]] == [True, False]
    assert rows[2].is_bot
    assert [r.bytes_changed for r in rows[3:6]] == [None, None, 0]
    assert [r.edit_id for r in rows[6:8]] == [88017, 88017]
    assert rows[8].wiki_db == "" and rows[9].editor == "Padded" and rows[10].ts == SENT


ADDRESSES = [
    "192.168.1.1", "8.8.8.8", "0.0.0.0", "255.255.255.255", "256.1.1.1", "999.1.1.1", "01.2.3.4", "1.2.3", "1.2.3.4.5",
    "ten.four.two.one", "Okafor", "", "Ada", "2024", "2001:db8::1", "::1", "::", "fe80::1", "fe80::1%eth0", "fe80::1%",
    "fe80::1%a%b", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
    "1::2:3:4:5:6:7:8", "1::2::3", ":::", "12345::", "g::1", "::ffff:1.2.3.4", "::ffff:1.2.3.400", "1.2.3.4::",
    "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "1:2:3:4:5:6:7:8%1", ":1", "1:", "1.2.3.4%eth0", "::1/64", "1.2.3.4\n",
]


def _valid(text: str) -> bool:
    try:
        ipaddress.ip_address(text)
        return True
    except ValueError:
        return False


def test_strict_addresses(spark):
    rows = spark.createDataFrame([(a,) for a in ADDRESSES], "a STRING").select("a", is_ip_strict(F.col("a")).alias("ip"))
    assert {r.a: r.ip for r in rows.collect()} == {a: _valid(a) for a in ADDRESSES}
    assert spark.sql("SELECT cast(NULL AS STRING) AS a").select(is_ip_strict(F.col("a"))).first()[0] is False


def test_loose_addresses(spark):
    want = {"Ada": True, "2024": True, "999.1.1.1": True, "Editor": False, "2001:db8::1": True, None: None}
    rows = spark.createDataFrame([(a,) for a in want], "a STRING").select("a", looks_like_ip_loose(F.col("a")).alias("ip"))
    assert {r.a: r.ip for r in rows.collect()} == want


def test_lenient_parser(spark):
    events = [
        BASE,
        changed(length=...),
        changed(revision=..., id=7),
        changed(id="wrong"),
        changed(id="wrong", revision=...),
        changed(user="  Padded "),
        changed(user=None),
        changed(bot=None, minor=None),
        changed(type="log"),
        changed(title=None),
        changed(revision={"new": 0}),
        "{bad",
    ]
    rows = parse_envelope(messages(spark, *events)).collect()
    assert [r.edit_id for r in rows] == [752, 752, 7, 752, 752, 752, 752]
    assert rows[1].bytes_changed == 0
    assert rows[4].editor == "  Padded "
    assert rows[5].is_anon is None
    assert json.loads(rows[0].raw_payload) == BASE


def test_replay_gives_the_same_rows(spark):
    landed = parse_envelope(messages(spark, BASE, changed(length=...), changed(user="10.0.0.1")))
    assert replay_envelopes(landed).drop("ingested_at").collect() == landed.drop("ingested_at").collect()


def test_publishing(spark):
    good, rejected = validate_envelopes(messages(spark, BASE, changed(type="log"), changed(wiki=None)))
    sent = to_keyed_messages(good).collect()
    assert [bytes(r.key).decode() for r in sent] == ["enwiki:Lighthouse", ":Lighthouse"]
    assert json.loads(bytes(sent[0].value)) == BASE
    assert [r.reason for r in rejected.collect()] == ["type"]
    assert publish_cap(good, 1).count() == 1 and publish_cap(good, 0).count() == 2


def test_landing_rules(spark):
    rows = parse_envelope(messages(spark, BASE, BASE, changed(user=None), changed(timestamp=None, revision={"new": 9})))
    good, quarantine = enforce_landing(rows)
    assert [r.edit_id for r in good.collect()] == [752]
    assert sorted(r.missing_column for r in quarantine.collect()) == ["editor", "ts"]
    again, _ = enforce_landing(rows, landed_keys=good)
    assert again.columns == rows.columns and again.count() == 0


def test_very_long_values_are_judged_not_fatal(spark):
    size = 1_000_000
    odd = [
        '"' + "a" * size + '"', '"' + '\\"' * (size // 2) + '"', "[" + "1," * (size // 4) + "1]", '"' + "a" * size, "[" * 50_000,
        json.dumps(changed(user="a:" * (size // 2))), json.dumps(changed(user=" " * size + "x" + " " * size)), json.dumps(changed(title="t" * size, comment="[" * size)),
    ]
    rows = checked(spark, *odd)
    assert [r.reason for r in rows] == ["not_object", "not_object", "not_object", "undecodable", "undecodable", None, None, None]
    assert not rows[5].is_anon and rows[6].editor == "x" and len(rows[7].page_title) == size


@pytest.mark.parametrize("name", ["a:" * 20_000, "1." * 20_000, ":" * 100_000, "%" * 100_000, "::1%" + "z" * 100_000])
def test_long_names_are_no_addresses_but_zones_may_be_long(spark, name):
    row = spark.createDataFrame([(name,)], "name STRING").select(is_ip_strict(F.col("name")).alias("ip")).first()
    assert row.ip == name.startswith("::1%")
