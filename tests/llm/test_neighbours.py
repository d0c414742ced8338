import math

import numpy as np
import pytest

from calipers.llm import neighbours


def exact(ids, vectors, query_ids, k):
    out = {}
    for q in query_ids:
        own = ids.index(q)
        far = [(math.dist(vectors[own], v), i) for n, (i, v) in enumerate(zip(ids, vectors, strict=True)) if n != own]
        out[q] = sorted(far)[:k]
    return out


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_recall_and_exact_scores(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = table.collect()
    ids, vectors = [r.vec_id for r in rows], [r.embedding for r in rows]
    got = {}
    for r in neighbours.search_hundredths(table).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    want = exact(ids, vectors, [i for i in ids if i % 100 == 0], 10)
    assert set(got) == set(want)
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, v) for _, s, v in found] == sorted((s, v) for _, s, v in found)
        for _, s, v in found:
            assert s == pytest.approx(math.dist(vectors[ids.index(q)], vectors[ids.index(v)]), rel=1e-12)
        hit += len({v for _, _, v in found} & {v for _, v in want[q]})
    assert hit >= 0.9 * 10 * len(want)


def test_probing_finds_every_code_within_the_radius():
    codes = np.random.default_rng(0).integers(0, 256, (3_000, 16), dtype=np.uint8)
    codes[:1000] = codes[0] ^ np.packbits(np.random.default_rng(1).random((1000, 128)) < 0.15, axis=1)
    tables = neighbours.Tables(codes)
    for radius in (0, 5, 20, 48):
        want = np.flatnonzero(np.bitwise_count(codes ^ codes[0]).sum(axis=1) <= radius)
        assert tables.within(codes[0], radius).tolist() == want.tolist()


def test_odd_rows(spark):
    v = [1.0, 2.0, 0.5]
    rows = [(0, v), (1, v), (2, v), (2, v), (3, [1.0, 2.0, 1.5]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 2.0]),
            (8, [1.0, float("nan"), 2.0]), (9, [float("inf"), 1.0, 1.0]), (None, v), (100, [9.0, 9.0, 9.0]), (200, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as rank", "2 as score")
    got = [tuple(r) for r in neighbours.search_hundredths(table).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got if g[0] == 0] == [(0, 1, 1), (0, 2, 2), (0, 3, 2), (0, 4, 3), (0, 5, 100)]
    assert [g[2] for g in got if g[0] == 100] == [3, 0, 1, 2, 2]
    assert not [g for g in got if g[0] == 200]
    assert neighbours.search_hundredths(table.limit(0)).count() == 0


def test_many_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)] + [(i, [float(i % 7), 1.0, float(i % 11), 2.0]) for i in range(300, 500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in neighbours.search_hundredths(table).collect()]
    assert sorted(g[2] for g in got if g[0] == 200) == list(range(10)) and {g[3] for g in got if g[0] == 200} == {0.0}
    assert sorted(g[2] for g in got if g[0] == 0) == list(range(1, 11))
