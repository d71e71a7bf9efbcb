"""Conversation repair, lexical search and min-max near-duplicates against plain Python, odd rows included."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest

from editpulse.llm import conversation_repair, decontaminate, lexical_search, minmax_dedup, url_lists
from editpulse.llm.tables import table

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPACE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    table(spark, SF_DIR, "documents")


# --- conversation repair ---------------------------------------------------------------------


def judged(rows):
    """(fault, role's initial) of each row"""
    seen, out = set(), []
    for _, role, text in rows:
        if not text.strip(SPACE):
            fault = "b"
        elif (role, text) in seen:
            fault = "d"
        else:
            fault = "" if text.rstrip(SPACE)[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append((fault, role[:1]))
    return out


def least(rows):
    """Cheapest first over (row, last initial), equal costs by audit: (cost, audit)."""
    todo, done = [(0, "", 0, "")], set()
    while todo:
        cost, audit, i, last = heapq.heappop(todo)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        due = "a" if last == "u" else "u"
        heapq.heappush(todo, (cost + 2, audit + "I", i, due))
        if i == len(rows):
            continue
        fault, initial = rows[i]
        heapq.heappush(todo, (cost + 3, audit + "D", i + 1, last))
        if fault not in ("b", "d"):
            extra = fault == "t"
            if initial == due or (initial == "s" and not last):
                heapq.heappush(todo, (cost + extra, audit + "K", i + 1, initial))
            heapq.heappush(todo, (cost + extra + 2, audit + "R", i + 1, due))


def applied(rows, audit):
    out, i, due = [], 0, 0
    for edit in audit:
        if edit in "KR":
            _, role, text = rows[i]
            out.append((role if edit == "K" else ("user", "assistant")[due], text))
            due = 0 if out[-1][0][0] in "sa" else 1
        elif edit == "I":
            out.append((("user", "assistant")[due], ""))
            due = 1 - due
        i += edit != "I"
    return out


def test_search_finds_the_least_audit():
    rng = random.Random(4)
    kinds = {"": conversation_repair.OTHER, "s": conversation_repair.SYSTEM, "u": conversation_repair.USER, "a": conversation_repair.ASSISTANT}
    for case in range(3000):
        rows = [(rng.choice(["", "", "", "t", "b", "d"]), rng.choice("suuuaaax").replace("x", "")) for _ in range(rng.randint(0, 9 if case else 400))]
        codes = [conversation_repair.GONE if f in ("b", "d") else kinds[r] for f, r in rows]
        found = conversation_repair.cheapest_repair(np.array(codes, np.int64), np.array([f == "t" for f, _ in rows], bool))
        assert tuple(found) == least(rows), rows


def test_repairs(spark):
    rng = random.Random(6)
    given = []
    for conv in [None, *range(60), -1]:
        for _ in range(rng.randint(1, 9)):
            turn = rng.choice([None, *range(6)])
            text = rng.choice([None, "", " \n", "a.", "b", "c!\t ", "long " * 3 + "?", "é…", "x.y"])
            row = (conv, turn, rng.choice(["user", "assistant", "system", "User", "", None, "tool", "sys", "u2"]), text, "clash", 1)
            given += [row] * rng.choice([1, 1, 1, 2])
    given += [(1000, i, ("user", "assistant")[i % 2], f"turn {i}" + ". " * (250_000 if i == 7 else i % 3), "k", 1) for i in range(300)]
    turns = spark.createDataFrame(given, "conv_id bigint, turn bigint, role string, text string, audit string, kind int").repartition(7)
    named = spark.createDataFrame([(5000,), (3,), (3,)], "conv_id bigint")
    found = conversation_repair.repairs(turns, named).cache()
    rows = {r.conv_id: r for r in found.collect()}
    by = defaultdict(list)
    for conv, turn, role, text, *_ in given:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    by[5000] = []
    assert set(rows) == set(by) and found.count() == len(by)
    expected = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = judged(own)
        counts = Counter(f for f, _ in faults)
        numbers = [r[0] for r in own if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for (_, a), (_, b) in zip(faults, faults[1:]))
        cost, audit = least(faults)
        r = rows[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit), own
        expected[conv] = applied(own, audit)
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in expected[conv]))
    repaired = defaultdict(list)
    for r in conversation_repair.repaired_turns(turns, found).orderBy("position").collect():
        assert r.position == len(repaired[r.conv_id])
        repaired[r.conv_id].append((r.role, r.text))
    assert {c: x for c, x in expected.items() if x} == repaired
    digests = {r.conv_id: r.repaired_sha256 for r in conversation_repair.repaired_digests(turns, found).collect()}
    assert digests == {c: hashlib.sha256("\n".join(f"{a}:{b}" for a, b in x).encode()).hexdigest() for c, x in expected.items()}


def test_repairs_of_nothing_and_of_texts_as_ids(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    found = conversation_repair.repairs(empty)
    assert found.count() == 0 and conversation_repair.repaired_digests(empty, found).count() == 0 and conversation_repair.repaired_turns(empty, found).count() == 0
    some = spark.createDataFrame([("c", 0, "user", "Hm."), ("c", 1, "assistant", "Ah.")], "conv_id string, turn int, role string, text string")
    assert [(r.conv_id, r.cost, r.audit) for r in conversation_repair.repairs(some).collect()] == [("c", 0, "KK")]


# --- lexical search --------------------------------------------------------------------------


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(documents, items, k):
    """item_id -> [(score, doc_id)] best first; ``documents`` in input order."""
    lists = [Counter(terms(t)) for _, t in documents]
    n_docs, total = sum(map(bool, lists)), sum(sum(c.values()) for c in lists)
    df = Counter(w for c in lists for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for w, d in df.items()}
    out = {}
    for item, times in items.items():
        scores = []
        for place, ((doc_id, _), c) in enumerate(zip(documents, lists)):
            m = 75 + (25 * sum(c.values()) * n_docs) // max(1, total)
            score = sum(n * weight[w] * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m)) for w, n in times.items() if c[w])
            if score:
                scores.append((-score, doc_id is not None, doc_id or 0, place))
        if scores:
            out[item] = [(-s, i if known else None) for s, known, i, _ in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("lane, bundle, k", [(8192, 256, 20), (7, 3, 2), (1, 1, 5)])
def test_lexical_search(spark, monkeypatch, lane, bundle, k):
    monkeypatch.setattr(lexical_search, "LANE_DOCUMENTS", lane)
    monkeypatch.setattr(lexical_search, "LANE_POSTINGS", 60 if lane < 8192 else 1 << 20)
    monkeypatch.setattr(lexical_search, "BUNDLE_ITEMS", bundle)
    rng = random.Random(8)
    vocabulary = [f"w{int(1.3 ** rng.uniform(0, 20))}" for _ in range(150)] + ["Été", "été", "ΣΑΣ", "it's", "naïve—word", "数字", "x1y"]

    def prose(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))

    documents = [(i, prose(rng.randint(1, 40))) for i in range(90)]
    documents += [(7, documents[3][1]), (3, documents[3][1]), (200, documents[3][1]), (None, documents[3][1]), (None, None), (201, None), (202, ""), (203, "-- \x00 \x1f [] "), (204, "W3 " * 100_000)]
    rng.shuffle(documents)
    items = [(i, prose(rng.randint(1, 12))) for i in range(8)] + [(3, prose(5)), (50, None), (51, ""), (52, "nowhere else"), (None, "été W3 w3 w3")]
    wanted = defaultdict(Counter)
    for item, text in items:
        wanted[item].update(terms(text))
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in documents], "doc_id bigint, text string, lane string, slot int").coalesce(1)
    given = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id bigint, text string, term string")
    rows = lexical_search.lexical_search(spark, docs, given, k).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        got[r.item_id].append((r.score, r.doc_id))
        assert r["rank"] == len(got[r.item_id])
    assert dict(got) == ranked(documents, wanted, k)


def test_lexical_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    for given, asked in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        assert lexical_search.lexical_search(spark, given, asked).count() == 0


# --- min-max near-duplicates -----------------------------------------------------------------


def shingled(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


@pytest.mark.parametrize("block_sets", [4096, 3])
def test_minmax_dedup(spark, monkeypatch, block_sets):
    monkeypatch.setattr(minmax_dedup, "BLOCK_SETS", block_sets)
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(500)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(40, 120))] for _ in range(20)]
    texts = [" ".join(w) for w in base] + [" ".join(w).upper() for w in base[:4]] + ["\n".join(w) for w in base[:3]]
    for w in base[:6]:
        # A chain: each copy differs a little more from the first.
        changed = list(w)
        for step in range(12):
            changed[rng.randrange(len(w))] = f"new{step}"
            texts.append(" ".join(changed))
    texts += [None, None, "", " \n", "one", "ONE", "one two three", "É one", "é one", " ".join(vocabulary * 40), "a b c d " * 50, "a b c d " * 60]
    ids = [None if i % 17 == 0 else i * 7 % 1000 for i in range(len(texts))]
    rows = [(i, t, 1, "x") for i, t in zip(ids, texts)] + [(ids[1], texts[1], 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, size int, node string").repartition(5)
    sets = [shingled(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                parent[find(x)] = find(y)
    groups = defaultdict(list)
    for x, (doc_id, *_) in enumerate(rows):
        groups[find(x)].append(doc_id)
    expected = []
    for x, (doc_id, *_) in enumerate(rows):
        known = [i for i in groups[find(x)] if i is not None]
        component = min(known, default=None)
        expected.append((doc_id, len(sets[x]), component, doc_id == component))
    got = [tuple(r) for r in minmax_dedup.minmax_dedup(spark, docs).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert max(map(len, groups.values())) > 8
    assert minmax_dedup.minmax_dedup(spark, docs.limit(0)).count() == 0


def test_both_ends_of_a_permutation_estimate_the_similarity():
    rng = np.random.default_rng(3)
    shared, own = rng.integers(1 << 63, size=800).astype(np.uint64), rng.integers(1 << 63, size=(2, 100)).astype(np.uint64)
    values = np.concatenate((shared, own[0], shared, own[1]))
    both = minmax_dedup.minmax(values, np.array([0, 900, 900, 1800]), 400)
    assert both.shape == (2, 800)
    agree = both[0] == both[1]
    assert abs(agree[:400].mean() - 0.8) < 0.08 and abs(agree[400:].mean() - 0.8) < 0.08 and abs(agree.mean() - 0.8) < 0.05


# --- bounds of earlier operators -------------------------------------------------------------


def test_hosts_longer_than_hosts_can_be_match_nothing(spark):
    listed = url_lists.list_intervals(spark.sql("SELECT 'l' AS list, 'a.org' AS entry, 'add' AS action, timestamp_ntz'2024-01-01' AS at"))
    rows = [(1, "http://" + "x." * 30_000 + "a.org/p"), (2, "http://" + "x." * 100 + "a.org/p"), (3, "http://" + "." * 60_000 + "/"), (4, "http://a.org/" + "y/" * 30_000)]
    captures = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "timestamp_ntz'2024-01-02' AS fetch_time")
    got = {r.page_id: (r.blocked, len(r.host)) for r in url_lists.asof_filter(captures, listed).collect()}
    assert got == {1: (False, 0), 2: (True, 205), 3: (False, 0), 4: (True, 5)}


def full_alignment(pattern, text, most):
    """The whole table: (edits, start, end), earliest end, then earliest start."""
    row = [(0, j) for j in range(len(text) + 1)]
    for k, p in enumerate(pattern):
        new = [(k + 1, 0)]
        for j, t in enumerate(text):
            new.append(min((row[j + 1][0] + 1, row[j + 1][1]), (row[j][0] + (p != t), row[j][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    cost, end = min((c, j) for j, (c, _) in enumerate(row))
    return (cost, row[end][1], end) if cost <= most else None


def test_the_band_holds_every_alignment():
    rng = random.Random(1)
    for _ in range(1500):
        pattern = [rng.randint(1, 4) for _ in range(rng.randint(1, 25))]
        text = list(pattern)
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, len(text))
            text[at : at + rng.randint(0, 1)] = [rng.randint(1, 4)] * rng.randint(0, 2)
        text = [rng.randint(1, 4) for _ in range(rng.randint(0, 6))] + text + [rng.randint(1, 4) for _ in range(rng.randint(0, 6))]
        most = rng.randint(0, 6)
        assert decontaminate.aligned(np.array(pattern, np.uint32), np.array(text, np.uint32), most) == full_alignment(pattern, text, most)
