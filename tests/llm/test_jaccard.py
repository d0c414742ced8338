import random

import numpy as np
import plain
import pytest

from calipers.llm import jaccard


def same(got, want):
    return sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = plain.near_classes([tuple(r) for r in docs.collect()])
    assert same(jaccard.classes(docs).collect(), want)


@pytest.mark.parametrize("block", [4, 512])
def test_groups_of_copies_and_odd_rows(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(40):
        own = list(base)
        for _ in range(i % 4):
            own[rng.randrange(120)] = word()
        rows.append((i, " ".join(own)))
    rows += [(100 + i, "one two three") for i in range(5)] + [(110, "One, two THREE!"), (111, "one two four")]
    rows += [(120, ""), (121, None), (122, "..."), (123, " "), (130, base[0]), (131, base[0] + " " + base[1])]
    rows += [(7, rows[7][1]), (140, "long " * 30_000), (141, "long " * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain.near_classes(rows)
    assert same(jaccard.classes(docs.repartition(5)).collect(), want)
    assert max(w[2] for w in want) > 15
    kept = [r.doc_id for r in jaccard.one_of_each(docs.selectExpr("*", "1 as label", "2 as links")).collect()]
    assert sorted(kept) == sorted({c for i, c, _ in want})
    assert jaccard.classes(docs.limit(0)).count() == 0


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "x y z u v w")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.classes(docs).collect()), key=str) == [(3, 3, 0), (None, None, 1), (None, None, 1)]
    assert jaccard.one_of_each(docs).count() == 2


def test_recall_of_far_pairs_beside_a_hot_group(spark):
    """A group with half a million pairs at 0.95 does not lower the recall of 1,000 separate pairs at 0.8."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    base, rows = [word() for _ in range(404)], []
    for i in range(1000):
        own = list(base)
        own[rng.randrange(5, 399)] = word()
        rows.append((i, " ".join(own)))
    for k in range(1000):
        own = [word() for _ in range(49)]
        rows.append((10_000 + 2 * k, " ".join(own)))  # 45 shingles, of which 40 are shared: 40 of 50
        rows.append((10_001 + 2 * k, " ".join([*own[:44], *(word() for _ in range(5))])))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == (0, 999) for i in range(1000))
    assert sum(got[10_001 + 2 * k] == (10_000 + 2 * k, 1) for k in range(1000)) >= 998


def test_prefix_is_shortened_to_the_target():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, 150, dtype=np.uint64) for _ in range(jaccard.MEASURED)]
    recalls = jaccard.measured_recalls(sets)
    for depth, recall in enumerate(recalls, 1):  # of pairs at 0.8, by chance
        assert abs(recall - (1 - (1 - 0.8**depth) ** jaccard.TREES)) < 0.006
    depths = [jaccard.shortened(recalls, target) for target in (0.98, 0.995, 0.999)]
    assert depths == [6, 5, 4]
    with pytest.raises(ValueError):
        jaccard.shortened([0.9, 0.8], 0.95)


def test_changed_pairs_are_at_the_least_similarity():
    own = np.arange(1, 46, dtype=np.uint64)
    left, right = jaccard.changed_pairs([own], 200)
    assert left.shape == right.shape == (200, jaccard.TREES * jaccard.DEPTH)
    assert abs((left == right).mean() - 40 / 50) < 0.02
