import math
import re
from collections import Counter

import numpy as np
import pytest

from calipers.llm import ranking

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=50):
    """Every score of every document."""
    counted = [(i, Counter(PATTERN.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(PATTERN.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc_id, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize(("k", "block", "batch"), [(50, 16_000_000, 8_000_000), (7, 60_000, 3_000)])
def test_documents(spark, k, block, batch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    want = plain([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()], k)
    assert rows_of(ranking.search(docs.repartition(3), items, k, block, batch)) == want


def test_odd_rows(spark):
    texts = ["Cat, dog", "cat_dog cat", "Éa éa", "b" * 500, None, "", " ,;", "cat " * 40, "cat", "cat", "every word", "every other"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "cat dog"), (None, "cat dog"), (3, "cat dog"), (9, "cat")]
    docs += [(100 + i, "every same tie") for i in range(70)]
    items = [(1, "cat dog DOG"), (1, "every"), (2, None), (3, ""), (4, "éa"), (None, "cat"), (5, "nowhere"), (6, "every tie"), (6, "every tie")]
    frame = spark.createDataFrame([(*r, 5, 6) for r in docs], "doc_id long, text string, item_id int, score int")
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    for block in (10, 10**7):
        assert rows_of(ranking.search(frame.repartition(4), asked, 50, block)) == plain(docs, items)
    assert ranking.search(frame.limit(0), asked).count() == 0
    assert ranking.search(frame, asked.limit(0)).count() == 0


def block_of(rng, n_docs, n_terms):
    held = rng.random((n_terms, n_docs)) < rng.random((n_terms, 1)) ** 3
    held[:, 0] = True
    term, doc = np.nonzero(held)
    row = {
        "doc_ids": rng.permutation(n_docs) * 3, "lengths": rng.integers(50, 900, n_docs), "terms": np.arange(n_terms),
        "counts": held.sum(axis=1), "holders": doc, "times": rng.integers(1, 9, len(doc)),
    }
    return ranking.Block.of(row, rng.integers(0, 9_000, n_terms), n_docs, int(row["lengths"].sum()))[1]


def test_stops_early_and_misses_nothing():
    rng = np.random.default_rng(3)
    saved = 0
    for _ in range(60):
        block = block_of(rng, 2_000, 8)
        lists = np.sort(rng.permutation(8)[: rng.integers(1, 5)])
        scores = np.zeros(2_000, dtype=np.int64)
        for t in lists:
            own = slice(block.begin[t], block.begin[t + 1])
            scores[block.key[own] - t * 2_000] += block.impact[own]
        order = np.lexsort((block.ids, -scores))[:10]
        top = ranking.Top.empty(10)
        saved += ranking.best_positions(block, lists, top) < (scores > 0).sum()
        kept = scores[order] > 0
        assert top.ids.tolist() == block.ids[order][kept].tolist() and top.scores.tolist() == scores[order][kept].tolist()
    assert saved > 20


def test_ties_with_the_kth_are_read():
    """Ten equal documents, two places: the least ids are found, wherever they stand in the list."""
    row = {
        "doc_ids": np.arange(100)[::-1].copy(), "lengths": np.full(100, 10), "terms": np.array([0]), "counts": np.array([100]),
        "holders": np.arange(100), "times": np.ones(100, dtype=np.int64),
    }
    _, block = ranking.Block.of(row, np.array([5]), 100, 1000)
    top = ranking.Top.empty(2)
    ranking.best_positions(block, np.array([0]), top)
    assert top.ids.tolist() == [0, 1]
