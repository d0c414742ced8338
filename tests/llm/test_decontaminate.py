import random

import numpy as np
import plain

from calipers.llm import decontaminate as d

RNG = random.Random(8)
word = lambda: "".join(RNG.choice("abcdefghijkl") for _ in range(RNG.randint(2, 7)))
ITEMS = [(i, " ".join(word() for _ in range(RNG.randint(5, 60)))) for i in range(60)]


def edited(text, edits):
    w = text.split()
    for _ in range(edits):
        k, at = RNG.randrange(3), RNG.randrange(len(w))
        if k == 0:
            w[at] = word()
        elif k == 1 and len(w) > 1:
            del w[at]
        else:
            w.insert(at, word())
    return " ".join(w)


def test_edited_items_are_found_and_distances_are_exact(spark):
    docs, planted = [], {}
    for k in range(600):
        i, text = ITEMS[k % len(ITEMS)]
        allowed = d.edits_allowed(len(text.split()))
        edits = RNG.randint(0, allowed) if k % 3 else 0
        parts = [word() for _ in range(RNG.randint(0, 80))], [word() for _ in range(RNG.randint(0, 80))]
        docs.append((k, " ".join([*parts[0], edited(text, edits), *parts[1]]).title()))
        planted[k, i] = edits
    clean = [(1000 + k, " ".join(word() for _ in range(300))) for k in range(50)]
    frame = spark.createDataFrame(docs + clean, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in d.leaks(frame, bench).collect()}
    texts = dict(docs + clean)
    items = dict(ITEMS)
    want = {}
    for (doc, item), edits in planted.items():
        cost = plain.edit_distance_to_part(plain.words(items[item]), plain.words(texts[doc]))
        assert cost <= edits
        want[doc, item] = cost
    assert set(got) <= set(want)
    assert len(set(want) - set(got)) <= 0.01 * len(want)
    assert all(got[key].distance == want[key] for key in got)
    kept = {r.doc_id for r in d.drop_leaking(frame, bench).collect()}
    assert kept == set(texts) - {doc for doc, _ in got}


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, "too short"), (4, ""), (None, "x y z u v w")], "item_id long, text string")
    rows = [(1, None), (2, ""), (None, "a one two three four five six b"), (3, "x y z u v w"), (3, "x y z u v w"), (4, "too short"), (5, "w " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.distance, r.first_word, r.end_word) for r in d.leaks(docs, items).collect()), key=str)
    assert got == [(3, None, 0, 0, 6), (3, None, 0, 0, 6), (4, 3, 0, 0, 2), (None, 1, 0, 1, 7)]
    assert d.leaks(docs.limit(0), items).count() == 0 and d.leaks(docs, items.limit(0)).count() == 0
    assert d.drop_leaking(docs.selectExpr("*", "1 as row", "2 as item_id"), items).columns == ["doc_id", "text", "row", "item_id"]


def test_several_passes(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_ITEMS", 7)
    docs = spark.createDataFrame([(i, "before " + t + " after") for i, t in ITEMS], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.leaks(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()}
    assert {(i, i) for i, _ in ITEMS} <= got


def test_short_items_stand_word_by_word(spark):
    rng = random.Random(4)
    some = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, some(1 + i % 4)) for i in range(24)] + [(24, "what is it"), (24, "what is it"), (25, "...")]
    docs = [(i, some(rng.randrange(12))) for i in range(60)] + [(60, "answer: what is it ok"), (61, "What, is it? what is it"), (62, "what is")]
    want = []
    for doc, text in docs:
        words = plain.words(text)
        for item, own in items:
            n = len(w := plain.words(own))
            place = next((k for k in range(len(words) - n + 1) if words[k: k + n] == w), None) if n else None
            want += [(doc, item, 0, n, place, place + n)] if place is not None else []
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.distance, r.item_words, r.first_word, r.end_word) for r in d.leaks(frame.repartition(3), bench).collect()]
    assert sorted(got) == sorted(want) and (60, 24, 0, 3, 1, 4) in got
    assert d.drop_leaking(frame, bench).count() == len(docs)
    kept = {r.doc_id for r in d.drop_leaking(frame, bench, least_words=3).collect()}
    assert kept == {doc for doc, _ in docs} - {doc for doc, _, _, n, *_ in want if n >= 3}


def test_drop_in_several_passes(spark, monkeypatch):
    docs = [(i, "before " + t + " after") for i, t in ITEMS] + [(100, "clean text without any item"), (101, None), (101, None)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, text_hash int, size int")
    monkeypatch.setattr(d, "BLOCK_ITEMS", 7)
    kept = d.drop_leaking(frame, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [100, 101, 101]


def test_best_match_against_plain():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 9)).astype(np.uint64), rng.integers(0, 4, rng.integers(0, 25)).astype(np.uint64)
        cost, s, e = d.best_match(a, b)
        assert cost == plain.edit_distance_to_part(a.tolist(), b.tolist())
        assert cost == plain.edit_distance_to_part(a.tolist(), b[s:e].tolist())


def test_long_items_are_all_found():
    rng = random.Random(12)
    some = lambda n: ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n)]
    items = [" ".join(some(2_560)) for _ in range(15)]
    texts = []
    for text in items:
        w = text.split()
        for _ in range(d.edits_allowed(len(w))):
            k, at = rng.randrange(3), rng.randrange(len(w))
            w[at:at + (k < 2)] = some(1) if k != 1 else []
        texts.append(" ".join([*some(40), *w, *some(40)]))
    index = d.build_index(list(range(15)), items, 0.99)
    got = {(text, item) for text, item, *_ in d.search([*texts, " ".join(some(4_000))], index)}
    assert got == {(i, i) for i in range(15)}


def test_verified_directly_as_walked_and_very_long(monkeypatch):
    texts = [" ".join(["before", edited(text, d.edits_allowed(len(text.split()))), "after"]) for _, text in ITEMS]
    walked = d.search(texts, d.build_index([i for i, _ in ITEMS], [t for _, t in ITEMS], 0.99))
    monkeypatch.setattr(d, "LONGEST_WALKED", 0)
    direct = d.search(texts, d.build_index([i for i, _ in ITEMS], [t for _, t in ITEMS], 0.99))
    assert set(walked) <= set(direct) and {(i, i) for i in range(len(ITEMS))} <= {r[:2] for r in direct}
    monkeypatch.undo()
    assert d.build_index([1], [" ".join(word() for _ in range(27_000))], 0.99).classes[0].exact
