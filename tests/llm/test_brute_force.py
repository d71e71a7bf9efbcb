"""Operators without SQL against plain Python on small fixtures, odd rows included."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from editpulse.llm import decontaminate, minhash, ngram_join, packing, paragraph_dedup, pseudonyms, queries, quality_ledger, sharding, toxicity
from editpulse.llm import token_files, tokenizing, url_lists
from editpulse.llm.batches import slices, texts_of, words
from editpulse.llm.components import components
from editpulse.llm.tables import table
from editpulse.session import new_work_dir

SF_DIR = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tie int, node string, score int"


def fixture_texts() -> list[str | None]:
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(600)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + (". " if rng.random() < 0.1 else "") for _ in range(n))

    base = [prose(rng.randint(30, 120)) for _ in range(25)]
    near = []
    for text in base[:8]:
        words = text.split()
        for _ in range(4):
            changed = list(words)
            for _ in range(rng.randint(0, 2)):
                changed[rng.randrange(len(changed))] = "changed"
            near.append("\n".join([" ".join(changed[:10]), " ".join(changed[10:])]))
    odd = [None, None, "", " \n\t ", "one", "one", "one two three", "é ü —   x y", "<|endoftext|> a <|ENDOFTEXT|>", prose(9000), "a\x00b c", "İstanbul ΣΑΣ é"]
    passage = "\n".join([prose(12) + "end of it.", prose(30)])
    shared = [f"{prose(20)} {passage} {prose(15)}" for _ in range(3)]
    return [*base, *base[:5], *near, *odd, *shared]


@pytest.fixture(scope="module")
def texts():
    return fixture_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    table(spark, SF_DIR, "documents")
    rows = [(i, t, ["en", "fr", None][i % 3], ["s0", "s0", None, "s1"][i % 4], None, 1, "x", 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    table(spark, SF_DIR, "documents")
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


WHOLE = Tokenizer.from_file(TOKENIZER)


def encoded(text, end):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_slices_of_a_batch(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts * 3)], names=["text"])
    got = []
    for part in slices(iter([batch.slice(2), batch.slice(0, 0)]), "text", 1500):
        own = texts_of(part, "text")
        own.validate(full=True)
        split = words(own)
        vocabulary = split.vocabulary.to_pylist()
        got += [[vocabulary[c] for c in split.codes[a:b]] for a, b in zip(split.offsets[:-1], split.offsets[1:])]
    assert got == [WORD.findall(t or "") for t in (texts * 3)[2:]]


def test_word_by_word_encoding_is_exact(texts):
    rng = random.Random(3)
    alphabet = "aAbé ñÉß \n\t\r\x0b\x0c\x1c  ΣσİiÍ'`´.,!?0123٣ⅫǄſﬀ漢字<|endoftext|>😀‍"
    odd = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    all_texts = [t or "" for t in texts] + odd + ["<|startoftext|>x", "it's we'll I'D"]
    encode = tokenizing.WordEncoder(TOKENIZER)
    for _ in range(2):
        ids, offsets = encode(pa.array(all_texts, pa.large_string()))
        for k, text in enumerate(all_texts):
            assert list(ids[offsets[k] : offsets[k + 1]]) == encoded(text, 0)[:-1], text


def test_memory_of_words_is_bounded(monkeypatch, texts):
    monkeypatch.setattr(tokenizing, "REMEMBERED", 20)
    encode = tokenizing.WordEncoder(TOKENIZER)
    for text in [t or "" for t in texts[:40]]:
        ids, _ = encode(pa.array([text], pa.large_string()))
        assert list(ids) == encoded(text, 0)[:-1]
    assert encode.places.count == 20


def test_token_files_round_trip(spark, docs, texts, empty):
    path = new_work_dir(spark, "tokens-test")
    token_files.write_token_files(docs, path, TOKENIZER, end_id=1)
    stored = {r.doc_id: r.ids for r in token_files.read_token_files(spark, path).collect()}
    start = 0
    rows = {r.doc_id: r for r in token_files.token_index(spark, path).collect()}
    for i, text in enumerate(texts):
        ids = encoded(text, 1)
        assert stored[i] == ids
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    token_files.write_token_files(empty, path + "-empty", TOKENIZER)
    assert token_files.token_index(spark, path + "-empty").count() == 0


@pytest.mark.parametrize("shard_tokens", [3000, 1 << 19])
def test_packing_keeps_every_id_once(spark, docs, texts, empty, monkeypatch, shard_tokens):
    monkeypatch.setattr(packing, "SHARD_TOKENS", shard_tokens)
    rows = packing.pack(spark, docs, TOKENIZER, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert len(r.ids) == r.length and crc(r.ids) == r.ids_crc32
    for i, text in enumerate(texts):
        ids = encoded(text, 2)
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert [x for r in pieces for x in r.ids] == ids
        assert [r.start for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces]])[:-1])
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    short = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces]])[:-1])
        size = sum(r.length for r in pieces)
        assert size <= 4096
        short += size < 4096
    assert short <= 5
    assert packing.pack(spark, empty, TOKENIZER).count() == 0


def test_bm25_puts_the_nearest_first():
    docs = [[1, 2, 3, 4], [9, 9, 8], [1, 2, 3, 7], [1, 8, 8, 8]]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    ids = np.array([x for d in docs for x in d], np.uint32)
    documents = np.bincount([x for d in docs for x in set(d)])
    known = packing.Statistics(np.flatnonzero(documents), documents[documents > 0], 4, len(ids))
    order = packing.Shard(ids, offsets, known).neighbours(0, np.array([False, True, True, True]))
    assert list(order) == [2, 3, 1]


def brute_links(texts):
    classes = defaultdict(list)
    for i, t in enumerate(texts):
        classes[" ".join(WORD.findall(t or ""))].append(i)
    sets = {k: shingles(k) for k in classes}
    links = defaultdict(set)
    keys = list(classes)
    for x in range(len(keys)):
        for y in range(x + 1, len(keys)):
            a, b = sets[keys[x]], sets[keys[y]]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[keys[x]].add(keys[y])
                links[keys[y]].add(keys[x])
    return classes, links


@pytest.mark.parametrize("block_sets", [4096, 2])
def test_ngram_join(spark, docs, texts, empty, monkeypatch, block_sets):
    monkeypatch.setattr(minhash, "BLOCK_SETS", block_sets)
    classes, links = brute_links(texts)
    root = {}
    for key in classes:
        group, todo = {key}, [key]
        while todo:
            for other in links[todo.pop()] - group:
                group.add(other)
                todo.append(other)
        root[key] = min(i for k in group for i in classes[k])
    rows = {r.doc_id: r for r in ngram_join.ngram_join(spark, docs).collect()}
    assert len(rows) == len(texts)
    assert any(links.values())
    for key, members in classes.items():
        for i in members:
            r = rows[i]
            expected = (min(members), root[key], len(members) - 1, len(links[key]), sum(len(classes[k]) for k in links[key]) + len(members) - 1)
            assert (r.text_id, r.class_id, r.n_copies, r.n_texts, r.n_links) == expected
    kept = ngram_join.keep_one(spark, docs.unionByName(docs.where("doc_id = 3")))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))
    assert ngram_join.ngram_join(spark, empty).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(7, 7)]
    rows = components(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 40)}}


def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j + 1] + 1, new[-1] + 1, row[j] + (p != t)))
        row = new
    return min(row)


def test_decontaminate(spark, docs, texts, empty):
    rng = random.Random(2)
    plain = [" ".join((t or "").lower().split()) for t in texts]
    items = [texts[0][:150], texts[1][20:120].upper(), "short 1", texts[2][:90].replace(" ", "\n"), "not in there at all, whatever one may look for"]
    broken = list(texts[3][:200])
    for at in rng.sample(range(200), 8):
        broken[at] = "#"
    too_broken = list(texts[4][:200])
    for at in range(0, 200, 10):
        too_broken[at] = "#"
    items += ["".join(broken), "".join(too_broken)]
    benchmark = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (0, items[0])], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminations(spark, docs, benchmark).collect()}
    expected = {}
    for k, item in enumerate(items):
        wanted = " ".join(item.lower().split())
        most = min(int(0.05 * len(wanted)), max(0, (len(wanted) - 12) // 12))
        for i, text in enumerate(plain):
            if len(text) < 3000:
                edits = 0 if wanted in text else edit_distance_inside(wanted, text) if most else 99
                if edits <= most:
                    expected[i, k] = edits
    assert {k: r.edits for k, r in found.items() if len(plain[k[0]]) < 3000} == expected
    assert {k for _, k in expected} == {0, 1, 3, 5}
    for (i, _), r in found.items():
        if r.edits == 0:
            assert plain[i][r.start : r.end] == " ".join(items[r.item_id].lower().split())
    clean = decontaminate.decontaminate(spark, docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(texts) - len({i for i, _ in found})
    assert decontaminate.contaminations(spark, empty, benchmark).count() == 0
    assert decontaminate.contaminations(spark, docs, benchmark.limit(0)).count() == 0


def paragraphs_of(text):
    out, current = [], []
    for line in (text or "").split("\n"):
        for word in WORD.findall(line):
            current.append(word)
            import xxhash

            if re.search(paragraph_dedup._SENTENCE_END, word) or xxhash.xxh3_64_intdigest(word) % 64 == 0:
                out.append(current)
                current = []
        if current:
            out.append(current)
            current = []
    return out


def test_paragraph_dedup(spark, docs, texts, empty):
    occurrences = [(i, at, tuple(p)) for i, t in enumerate(texts) for at, p in enumerate(paragraphs_of(t)) if len(p) >= 8]
    distinct = sorted({p for _, _, p in occurrences})
    parent = {p: p for p in distinct}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    sets = {p: shingles(" ".join(p)) for p in distinct}
    for x, a in enumerate(distinct):
        for b in distinct[x + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    clusters = defaultdict(list)
    for i, at, p in occurrences:
        clusters[find(p)].append((i, at, len(p)))
    expected = {(i, at): (n, min(group)[0]) for group in clusters.values() for i, at, n in group if (i, at, n) != min(group)}
    removed = paragraph_dedup.repeated_paragraphs(spark, docs)
    rows = removed.collect()
    assert {(r.doc_id, r.at): (r.words, r.kept_doc_id) for r in rows} == expected and len(rows) == len(expected) > 20
    cleaned = paragraph_dedup.without_paragraphs(docs, removed)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        cut = {at for i, at in expected if i == r.doc_id}
        left = [w for at, p in enumerate(paragraphs_of(texts[r.doc_id])) if at not in cut for w in p]
        assert WORD.findall(r.text or "") == left
        assert cut or r.text == texts[r.doc_id]
    assert paragraph_dedup.repeated_paragraphs(spark, empty).count() == 0


def test_passages_without_long_sentences_are_found(spark):
    table(spark, SF_DIR, "documents")
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(5000)]

    def prose(n, stop=0):
        return " ".join(rng.choice(vocabulary) + (rng.choice([".", ".\n"]) if stop and k % stop == stop - 1 else "") for k in range(n))

    rows, planted = [], {}
    for i in range(60):
        size, stop = rng.randint(50, 100), [0, 4, 6][i % 3]
        passage = prose(size, stop)
        planted[2 * i + 1] = passage.split()
        for doc in (2 * i, 2 * i + 1):
            rows.append((doc, f"{prose(rng.randint(10, 90), 15 * (i % 2))} {passage} {prose(rng.randint(10, 90))}"))
    rows += [(1000, "la " * 100_000), (1001, "one. two. three."), (1002, None)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string")
    removed = paragraph_dedup.repeated_paragraphs(spark, given, whole=True)
    cleaned = {r.doc_id: (r.text or "").split() for r in paragraph_dedup.without_paragraphs(given, removed, whole=True).collect()}
    shares = []
    for doc, text in rows[:120]:
        gone = len(text.split()) - len(cleaned[doc])
        if doc % 2:
            shares.append(gone / len(planted[doc]))
            assert gone <= len(planted[doc]) + 8
        else:
            assert gone == 0
    assert min(shares) > 0 and sum(shares) / len(shares) > 0.6
    split, _, bounds, before = paragraph_dedup._paragraphs(pa.array([t or "" for _, t in rows], pa.large_string()), whole=True)
    counts = np.diff(bounds)
    assert counts.sum() == len(split.codes) and (counts < 8).sum() == 1 and counts.max() < 24
    print(min(shares), sum(shares) / len(shares))


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def test_pseudonyms(spark, empty):
    table(spark, SF_DIR, "documents")
    rows = [
        (1, "write to Jo.Doe-7@mail.example.org, pay 4952935900253052! or 4952-9359-0025-3052"),
        (2, "call +1 (017) 555-7713 from 10.0.0.1 on 2024-02-29; ssn 123-45-6789."),
        (3, "4952935900253052 jo.doe-7@mail.example.org 10.0.0.1"),
        (4, "no: 4952935900253053, 256.1.1.1, 2023-02-30, 1.2.3.4.5, v1.2, 12345678901234567890123"),
        (5, None), (6, ""), (7, "2024-02-29" * 2), (7, "x " * 50_000 + "10.0.0.1"),
    ]
    done = pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id int, text string"), "k")
    got = [(r.doc_id, r.text, [(p.kind, p.value) for p in r.pii]) for r in done.orderBy("doc_id", F.length("text")).collect()]
    text = {i: t for i, t, _ in got if i < 7}
    kinds = {i: [k for k, _ in p] for i, _, p in got if i < 7}
    assert kinds == {1: ["email", "card", "card"], 2: ["phone", "ipv4", "date", "ssn"], 3: ["card", "email", "ipv4"], 4: [], 5: [], 6: []}
    values = {i: [v for _, v in p] for i, _, p in got}
    assert re.fullmatch(r"[a-z]{2}\.[a-z]{3}-[0-9]@mail\.example\.org", values[1][0]) and luhn(values[1][1])
    assert values[1][1] == values[1][2].replace("-", "") == values[3][0] and values[1][0] == values[3][1] and values[2][1] == values[3][2]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", values[2][0]) and re.fullmatch(r"\d{4}-\d\d-\d\d", values[2][2])
    for i, original in rows[:3]:
        for v in re.findall(r"4952[0-9-]+|\S+@\S+\w|10\.0\.0\.1|2024-02-29|123-45-6789|555-7713", original):
            assert v not in text[i]
    assert text[4] == rows[3][1] and text[5] is None and text[6] == ""
    assert got[-1][1].startswith("x x x") and got[-1][1] != rows[-1][1]
    other = pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id int, text string"), "other").where("doc_id = 3").first()
    assert other.text != text[3]
    assert pseudonyms.pseudonymise(empty, "k").count() == 0


def test_pseudonyms_are_a_permutation(spark):
    numbers = [(f"{i:03d}-45-6789",) for i in range(1, 600)]
    done = pseudonyms.pseudonymise(spark.createDataFrame(numbers, "text string"), "k").collect()
    assert len({r.text for r in done}) == len(numbers)
    days = spark.sql("SELECT explode(sequence(date'1990-01-01', date'2020-12-31')) AS d").select(F.date_format("d", "yyyy-MM-dd").alias("text"))
    assert pseudonyms.pseudonymise(days, "k").select("text").distinct().count() == days.count()


def test_dates_of_all_accepted_years_are_permuted(spark):
    days = spark.sql("SELECT explode(sequence(date'1600-01-01', date'2099-12-31')) AS d").select(F.date_format("d", "yyyy-MM-dd").alias("text"))
    done = pseudonyms.pseudonymise(days.repartition(8), "k").select("text").distinct()
    assert done.count() == days.count() and done.where("text not between '1600-01-01' and '2099-12-31'").count() == 0


def test_pseudonyms_of_values_next_to_other_digits(spark):
    table(spark, SF_DIR, "documents")
    card = "4111 1111 1111 1111"
    cases = [
        ("4111111111111111 12/27", ["card"], " 12/27"), (f"{card} 737", ["card"], " 737"), (f"2 {card}", ["card"], ""), (f"{card} {card}", ["card"] * 2, ""),
        (f"7 {card}-12 5", ["card"], "-12 5"), ("3782 822463 10005 1234", ["card"], " 1234"), ("41111111 11111111 737", ["card"], " 737"),
        ("order 1234 123-45-6789", ["ssn"], ""), ("555-123-4567 2024-01-05", ["phone", "date"], ""), (f"+14155552671 {card}", ["phone", "card"], ""),
        ("+49 30 1234567", ["phone"], ""), ("+44 (0)20 7946 0958 2024-01-05", ["phone", "date"], ""), (f"12 123-45-6789 {card} 10.0.0.1", ["ssn", "card", "ipv4"], ""),
        ("1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21", [], " 21"), ("4111 1111 1111 1112", [], " 1112"), ("7 8 " * 20_000 + card, ["card"], ""),
    ]
    rows = [(i, text) for i, (text, _, _) in enumerate(cases)]
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id int, text string"), "k").collect()}
    for i, (text, kinds, rest) in enumerate(cases):
        assert [p.kind for p in got[i].pii] == kinds and got[i].text.endswith(rest), text[-60:]
        assert re.sub("[0-9]", "0", got[i].text) == re.sub("[0-9]", "0", text) or "ipv4" in kinds
        assert (got[i].text == text) == (not kinds) and card not in got[i].text and "123-45-6789" not in got[i].text
        assert all(luhn(p.value) for p in got[i].pii if p.kind == "card")
    assert got[0].pii[0].value == got[1].pii[0].value.replace(" ", "") and got[10].text.startswith("+49 ")


def test_toxicity_on_held_out_rows(spark, empty):
    rows = queries.op3_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    assert right > 0.95 and caught > 0.6
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_odd_rows(spark, docs, empty, texts):
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1) for i in range(60)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score_toxicity(docs, model)
    assert scored.columns == [c for c in docs.columns if c != "score"] + ["score", "flagged"]
    assert scored.count() == len(texts) and scored.where("score is null or not score between 0 and 1").count() == 0
    silent = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score_toxicity(empty, silent).count() == 0
    assert toxicity.score_toxicity(docs, silent).where("flagged").count() == 0


def test_toxicity_learns_from_every_labelled_row(spark):
    ids = spark.range(6000).where(~toxicity.held_out("id")).orderBy(F.xxhash64("id")).limit(4400)
    # The last of the toxic rows by the hash of their ids alone have the one word, all others the other.
    rows = [(r.id, "lorem ipsum zorp" if i >= 4200 else "lorem ipsum blarg", 1) for i, r in enumerate(ids.collect())]
    rows += [(10_000 + i, f"lorem ipsum calm {'dolor' if i % 2 else 'amet'}", 0) for i in range(2000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(4)
    model = toxicity.fit(table.drop("toxic"), table.drop("text"))
    asked = spark.createDataFrame([(0, "zorp"), (1, "blarg"), (2, "calm"), (3, "dolor calm amet")], "doc_id bigint, text string")
    found = {r.doc_id: r.score for r in toxicity.score_toxicity(asked, model).collect()}
    assert found[0] > 0.9 and found[1] > 0.9 and found[2] < 0.3 and found[3] < 0.3


def test_toxicity_thresholds_count_all_rows(spark):
    """Against plain Python: the best F0.5 by language, over all rows and for a language with too few toxic ones."""
    vocabulary, rows = ["zorp", "blarg", "calm", "dolor", "amet"], []
    for i in range(3000):
        lang = ("en", "de", "", "xx")[i % 4 if i % 40 else 3]
        text = " ".join(vocabulary[(i * k * 7 + i // 13) % 5] for k in range(1, 4))
        rows.append((i, text, lang, int("zorp" in text and i % 5 > 0 and (lang != "xx" or i % 40 == 0))))
    model = toxicity.fresh()
    split = words(pa.array([r[1] for r in rows], pa.large_string()))
    pairs = toxicity.buckets_of(split)
    codes = (pairs[:, 0] * toxicity.BUCKETS + pairs[:, 1])[split.codes]
    stored = [(lang, toxic, codes[a:b].tolist()) for (_, _, lang, toxic), a, b in zip(rows, split.offsets, split.offsets[1:])]
    model.weight *= 40
    got = toxicity._thresholds(model, spark.createDataFrame(stored, "lang string, toxic int, words array<bigint>").repartition(3))
    scores = toxicity.scores(model, pa.array([r[1] for r in rows], pa.large_string()))
    steps = [min(int(x * toxicity.BINS), toxicity.BINS - 1) for x in scores]

    def best(own):
        cuts = {steps[i] for i in own}
        hits, above = (lambda c: sum(rows[i][3] for i in own if steps[i] >= c)), (lambda c: sum(steps[i] >= c for i in own))
        toxic = sum(rows[i][3] for i in own)
        return max(toxicity.LEAST, max((1.25 * hits(c) / (above(c) + 0.25 * toxic), c) for c in cuts)[1] / toxicity.BINS)

    by_lang = {lang: [i for i, r in enumerate(rows) if r[2] == lang] for lang in ("en", "de", "", "xx")}
    want = {"": best(range(len(rows)))} | {lang: best(own) for lang, own in by_lang.items() if lang and sum(rows[i][3] for i in own) >= 20}
    assert got == pytest.approx(want) and len(want) > 1


def test_shards(spark, docs, empty):
    rows = sharding.interleave_shards(docs.unionByName(docs.where("doc_id < 9")), 4, key="doc_id").collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert sorted(by) == [0, 1, 2, 3]
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    total = defaultdict(int)
    for r in rows:
        total[r.source] += 1
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        for source, n in total.items():
            assert abs(sum(r.source == source for r in members) - n / 4) <= 2
    assert sharding.interleave_shards(empty).count() == 0


def test_ledger_odd_rows(spark, docs, texts, empty):
    ledger = quality_ledger.rule_ledger(docs)
    rows = {r.doc_id: r for r in ledger.collect()}
    for i, text in enumerate(texts):
        assert rows[i].n_words == len(WORD.findall(text or ""))
        assert (rows[i].n_words < 10) == bool(rows[i].failed & 1)
    policy = quality_ledger.POLICIES["v3"]
    counts = {r.rule: r for r in quality_ledger.ablations(ledger, policy).collect()}
    assert counts["few_words"].fails == sum(r.n_words < 10 for r in rows.values())
    assert counts["few_words"].policy_rejects == sum(r.failed != 0 for r in rows.values())
    assert quality_ledger.rule_ledger(empty).count() == 0


def test_list_intervals(spark):
    at = "timestamp_ntz'2024-01-{:02d}'"
    events = [("add", 1), ("add", 2), ("remove", 5), ("remove", 6), ("add", 9), ("add", 12), ("remove", 12), (None, 3)]
    rows = " UNION ALL ".join(f"SELECT 'l' AS list, 'a.org' AS entry, {repr(a) if a else 'NULL'} AS action, {at.format(d)} AS at" for a, d in events)
    found = url_lists.list_intervals(spark.sql(rows)).orderBy("valid_from")
    assert [(r.valid_from.day, r.valid_to.day) for r in found.collect()] == [(1, 5), (9, 12)]
    captures = spark.sql(
        "SELECT * FROM VALUES (1, 'HTTP://u:p@x.A.org:80/p', timestamp_ntz'2024-01-01'), (2, 'http://a.org', timestamp_ntz'2024-01-05'),"
        " (3, NULL, timestamp_ntz'2024-01-02'), (4, 'no url', NULL), (5, 'http://ba.org/', timestamp_ntz'2024-01-02'),"
        " (1, 'HTTP://u:p@x.A.org:80/p', timestamp_ntz'2024-01-01') AS t(page_id, url, fetch_time)"
    )
    got = {r.page_id: (r.blocked, r.copies, r.host) for r in url_lists.asof_filter(captures, found).collect()}
    assert got == {1: (True, 2, "x.a.org"), 2: (False, 1, "a.org"), 3: (False, 1, ""), 4: (False, 1, ""), 5: (False, 1, "ba.org")}


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    docs = table(spark, SF_DIR, "documents")
    assert rows.select("doc_id").distinct().count() < docs.count()
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, step, SF_DIR)
        assert out.columns == docs.columns, name
        assert out.count() <= step.count()
        step = out
    left = {r.doc_id for r in step.select("doc_id").collect()}
    assert left == {r.doc_id for r in rows.select("doc_id").distinct().collect()}


def test_pseudonyms_stay_valid_and_differ(spark):
    table(spark, SF_DIR, "documents")
    rng = random.Random(12)
    ssns = sorted({f"{rng.choice([*range(1, 666), *range(667, 900)]):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}" for _ in range(3000)})
    letters = "abcdefghijklmnopqrstuvwxyz"
    emails = [f"{a}{b}@mail.org" for a in letters for b in letters] + [f"{a}@x.org" for a in letters] + [f"a{d}.{c}-b@x.org" for d in range(10) for c in letters]
    phones = sorted({f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(0, 9999):04d}" for _ in range(2000)})
    rows = [(kind, v) for kind, values in (("ssn", ssns), ("email", emails), ("phone", phones)) for v in values]
    done = pseudonyms.pseudonymise(spark.createDataFrame(rows, "kind string, text string"), "k").collect()
    by = defaultdict(list)
    for r in done:
        assert [p.kind for p in r.pii] == [r.kind], r
        by[r.kind].append(r.text)
    for kind, values in (("ssn", ssns), ("email", emails), ("phone", phones)):
        assert len(set(by[kind])) == len(values), kind
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", v) for v in by["ssn"])
    assert all(re.fullmatch(r"[2-9]\d\d-[2-9]\d\d-\d{4}", v) for v in by["phone"])
    assert sum(a == b for a, b in zip(sorted(by["email"]), sorted(emails))) < len(emails)
    again = pseudonyms.pseudonymise(spark.createDataFrame([("Ab@mail.org and ab@mail.org",)], "text string"), "k").first()
    assert again.pii[0].value == again.pii[1].value and again.pii[0].value in by["email"]


@pytest.mark.parametrize("piece", ["a.", "a@", "a-", "1-", "1 ", "1.", "+1", "(1", "123-45-", "2024-01-", "4111 ", "+1 (2) ", "a@a.", "x@1.2."])
def test_long_runs_do_not_end_the_search(spark, piece):
    table(spark, SF_DIR, "documents")
    text = f"x a@{piece * (400_000 // len(piece))}com and 10.0.0.1"
    row = pseudonyms.pseudonymise(spark.createDataFrame([(text,)], "text string"), "k").first()
    assert row.text.endswith(row.pii[-1].value) and row.pii[-1].kind == "ipv4" and not row.text.endswith("10.0.0.1")
