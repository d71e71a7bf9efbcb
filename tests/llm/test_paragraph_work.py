"""The cuts and the sets of paragraphs, and that no more is worked on than is wanted."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from editpulse.llm import minhash, paragraph_dedup


def _plain_cuts(chosen, wanted, ranks, least):
    """The rule place by place: in each round every free place of the smallest rank near it is taken."""
    taken = {int(i) for i in np.flatnonzero(chosen)}
    for _ in range(24):
        free = [i for i in range(least - 1, len(chosen)) if wanted[i] and all(i + d not in taken for d in range(1 - least, least))]
        if not free:
            return taken
        value = {i: int(ranks[i]) for i in free}
        near = lambda i: [j for j in range(i - least + 1, i + least) if j != i and j in value]
        taken |= {i for i in free if all((value[i], i) < (value[j], j) for j in near(i))}
    last = -least
    for place in free:
        if place - last >= least:
            taken.add(place)
            last = place
    return taken


def test_cuts_are_those_of_the_plain_rule():
    rng = np.random.default_rng(3)
    for kinds in (1, 3, 1 << 60):
        for least in (2, 8, 12):
            for share in (0.1, 1.0):
                chosen, wanted = rng.random(700) < 0.01, rng.random(700) < share
                ranks = rng.integers(0, kinds, 700).astype(np.uint64)
                found = paragraph_dedup._spaced_cuts(chosen, wanted, ranks, least)
                assert set(np.flatnonzero(found).tolist()) == _plain_cuts(chosen, wanted, ranks, least)


def test_later_rounds_look_at_free_places_alone(monkeypatch):
    seen, plain = [], paragraph_dedup._least_before
    monkeypatch.setattr(paragraph_dedup, "_least_before", lambda x, reach: seen.append(len(x)) or plain(x, reach))
    ranks = np.random.default_rng(4).integers(0, 1 << 60, 50_000).astype(np.uint64)
    paragraph_dedup._spaced_cuts(np.zeros(50_000, bool), np.ones(50_000, bool), ranks, 12)
    assert sum(seen) <= 4 * 50_000


def test_only_wanted_paragraphs_become_sets(spark):
    texts = [" ".join(f"w{n}x{k}" for k in range(90)) for n in range(4)]
    docs = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (2, texts[1]), (None, texts[2]), (4, None), (5, "")], "doc_id bigint, text string")
    found = paragraph_dedup.paragraphs(docs, True)
    assert found.groupBy("doc").count().where("count > 2").count() == 3
    every = {r["node"] for r in found.collect()}
    all_sets = paragraph_dedup._sets(docs, found.select("doc", "at").distinct(), True).collect()
    assert {r["node"] for r in all_sets} == every and len(all_sets) == len(every)
    sizes = {r["node"]: r["words"] - minhash.SHINGLE + 1 for r in found.collect()}
    assert all(len(set(r["shingles"])) == len(r["shingles"]) == sizes[r["node"]] for r in all_sets)
    wanted = found.where("at = 1")
    some = paragraph_dedup._sets(docs, wanted.select("doc", "at").distinct(), True)
    assert sorted(map(str, some.collect())) == sorted(str(r) for r in all_sets if r["node"] in {w["node"] for w in wanted.collect()})
    # A place that a text does not have gives nothing.
    assert paragraph_dedup._sets(docs, wanted.select("doc", F.lit(10_000).alias("at")).distinct(), True).count() == 0
