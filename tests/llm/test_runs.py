import hashlib
import re
import zlib

import numpy as np
import pytest

from calipers.llm import runs


def plain_runs(words, least=12):
    """(start, length, period) by comparing the words at every lag."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in found), default=None)
    return (
        doc_id, len(found), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def fast_runs(texts):
    counts = np.array([len(t) for t in texts], dtype=np.int64)
    joined = np.array([x for t in texts for x in t], dtype=np.int64)
    text, found = runs.runs_of(joined, counts)
    got = [[] for _ in texts]
    for t, s, e, q in zip(text.tolist(), found.start.tolist(), found.end.tolist(), found.period.tolist()):
        got[t].append((s, e - s, q))
    return got


def loops(rng):
    """Sequences with loops of loops, nearly repeated roots and random joins."""
    root = rng.integers(0, rng.integers(1, 4), rng.integers(1, 12)).tolist()
    out = []
    for _ in range(rng.integers(1, 4)):
        for _ in range(rng.integers(1, 4)):
            part = root * int(rng.integers(1, 8)) + root[: rng.integers(0, len(root) + 1)]
            out += part * int(rng.integers(1, 4))
        if rng.random() < 0.5:
            out.append(int(rng.integers(0, 5)))
        root = (root + root[: rng.integers(0, len(root) + 1)])[:40]
    return (out * int(rng.integers(1, 4)))[: 700]


def test_loops_of_loops():
    rng = np.random.default_rng(11)
    for _ in range(25):
        texts = [loops(rng) for _ in range(6)]
        assert fast_runs(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_random_words(letters):
    rng = np.random.default_rng(letters)
    texts = [rng.integers(0, letters, n).tolist() for n in (0, 1, 11, 12, 63, 64, 65, 300, 500)]
    texts += [t * 3 for t in texts[3:8]] + [texts[7] + texts[8] + texts[7]]
    assert fast_runs(texts) == [plain_runs(t) for t in texts]


def test_squares_of_periodic_roots():
    texts = []
    for unit in ([0], [0, 1], [0, 0, 1], [0, 1, 0, 0, 1]):
        for n in (33, 40, 64, 65, 77, 100, 128, 150):
            root = (unit * n)[:n]
            texts += [root * 2, [7, *root, *root, 8], root * 3, root + root[::-1], root[1:] + root]
    a, b = [0], [0, 1]
    while len(b) < 800:
        a, b = b, b + a
    texts += [a, b, [bin(i).count("1") % 2 for i in range(1024)]]
    assert fast_runs(texts) == [plain_runs(t) for t in texts]


def test_equal_hashes_are_checked():
    """Words whose hashes agree by chance do not make a run."""
    scale = runs.Scale(np.array([-1, 5, 6, 7, 8, 5, 6, 7, 9, 5, -2]))
    scale.hashes = lambda begin, size: np.zeros(len(begin), dtype=np.uint64)
    assert scale.extended(np.array([1]), np.array([4])).start.tolist() == []
    scale = runs.Scale(np.array([-1, 5, 6, 7, 8, 5, 6, 7, 8, 5, -2]))
    scale.hashes = lambda begin, size: np.zeros(len(begin), dtype=np.uint64)
    assert [x.tolist() for x in vars(scale.extended(np.array([1]), np.array([4]))).values()] == [[1], [10], [4]]


def rows_of(df):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted(map(tuple, df.select(*names).collect()), key=str)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(runs.run_rows(docs)) == sorted((plain_row(*r) for r in rows), key=str)
    assert sum(plain_row(*r)[1] > 0 for r in rows) > 5


def test_odd_rows(spark):
    looped = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(None, None), (None, "a " * 30), (1, None), (2, ""), (3, " \t\n"), (4, "a b c " * 9), (4, "a b c " * 9)]
    rows += [(looped, None), (looped, " "), (looped, text), (looped, "one"), (looped, f"\n {text}\r\n{text} "), (5, "x\x0by " * 6 + "x")]
    rows += [(6, (text + "\n") * 3), (7, "é " * 5_000), (8, "a b " * 6 + "b a " * 6)]
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id long, text string, runs string, words int")
    assert rows_of(runs.run_rows(docs)) == sorted((plain_row(*r) for r in rows), key=str)
    assert runs.run_rows(docs.limit(0)).count() == 0


def test_collapsed_text_and_runs(spark):
    docs = spark.createDataFrame([(1, "so " + "well well then " * 5 + "end")], "doc_id long, text string")
    row = runs.find(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 15, 3)] and row.collapsed == "so well well then end"
