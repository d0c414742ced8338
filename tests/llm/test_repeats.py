import numpy as np
import pandas as pd
import plain
import pytest

from calipers.llm import repeats


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("chunk", [3_000, 2_000_000])
def test_documents_against_brute_force(spark, chunk):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = plain.trimmed([tuple(r) for r in docs.collect()])
    assert rows_of(repeats.trimmed(docs.repartition(5), chunk)) == sorted(want, key=str)
    assert sum(r[2] for r in want) > 0


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    text = lambda n: "".join(rng.choice(list("abcdé \n"), n))
    shared, other = text(400), text(90)
    rows = [(i, text(60) + shared[i % 7: 400 - 3 * i] + text(40)) for i in range(30)]
    rows += [(40, other), (40, other), (39, other + other), (None, shared), (None, shared), (None, None), (50, ""), (51, None)]
    rows += [(60, "a" * 5_000), (61, "a" * 777), (62, "ab" * 3_000), (63, "b" + "ab" * 900), (-5, shared[100:149]), (-6, shared[100:150])]
    rows += [(70, "x" * 49), (71, "x" * 49), (72, "x" * 50), (73, "x" * 51)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (150, 1_000, 10**6):
        assert rows_of(repeats.trimmed(docs.repartition(3), chunk, 500)) == sorted(plain.trimmed(rows), key=str)
    assert repeats.trimmed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [
    [(1, None)], [(1, "")], [(1, "short")], [(1, None), (2, ""), (3, None)], [(None, "x" * 60), (1, "x" * 60)],
    [(i, None if i % 2 else "the same text of more than fifty bytes, in three rows of six") for i in range(6)],
])
def test_chunks_of_nothing(spark, rows):
    repeats._POWERS.clear()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, uid int, ids int")
    for chunk in (1, 10**6):
        assert rows_of(repeats.trimmed(docs.repartition(3), chunk)) == sorted(plain.trimmed(rows), key=str)


def test_groups_in_parts(spark, monkeypatch):
    """Many windows of a group, resolved a few at a time."""
    rng = np.random.default_rng(8)
    parts = ["".join(rng.choice(list("abcd "), 70)) for _ in range(12)]
    rows = [(i, "".join(parts[k] for k in rng.integers(0, 12, 4))[rng.integers(9):]) for i in range(40)]
    monkeypatch.setattr(repeats, "TOGETHER", 10)
    chunks = [repeats.opened(*(repeats._packed(np.frombuffer(x, t)) for x, t in (
        (np.array([i]).tobytes(), "<i8"), (np.array([len(t)]).tobytes(), "<i8"), (t.encode(), "u1")))) for i, t in rows]
    seen = [(c.ids, np.arange(len(c.data) - 49)) for c in chunks]
    message = pd.DataFrame([{
        "a": repeats._packed(np.zeros(1, "<u4")), "b": repeats._packed(c.ids), "c": repeats._packed(np.array([len(c.data) - 49], "<u4")),
        "d": repeats._packed(c.data)} for c in chunks])
    got = repeats._repeated(message)
    first = {}
    for c, (_, at) in zip(chunks, seen):
        for k in at:
            first.setdefault(c.data[k: k + 50].tobytes(), int(c.ids[0]))
    for c, bits in zip(chunks, got):
        assert bits.tolist() == [first[c.data[k: k + 50].tobytes()] < c.ids[0] for k in range(len(c.data) - 49)]


def test_kept_bytes(spark):
    line = "the same line of more than fifty bytes stands in both of them, " * 2
    docs = spark.createDataFrame([(1, "first " + line, 7), (2, "second " + line, 8)], "doc_id long, text string, n_bytes int")
    kept = {r.doc_id: bytes(r.kept) for r in repeats.trimmed(docs, texts=True).collect()}
    assert kept == {1: ("first " + line).encode(), 2: b"second"}


def test_smaller_neighbours():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 200):
        v = rng.integers(0, 9, n)
        before, after = repeats.smaller_neighbours(v)
        for i in range(n):
            assert before[i] == max([j for j in range(i) if v[j] < v[i]], default=-1)
            assert after[i] == min([j for j in range(i + 1, n) if v[j] < v[i]], default=n)
