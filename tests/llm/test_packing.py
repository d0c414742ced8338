import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from calipers.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
ENCODER = packing.Encoder(open(PATH).read())


def checked(rows, docs, capacity):
    """The pieces are those of the plain tokenizer, and sequences are filled without gaps or overlaps."""
    want = []
    for doc_id, text in docs:
        ids = np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start: start + capacity]
            want.append((doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for parts in inside.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(inside), -(-sum(r[3] for r in want) // capacity)


@pytest.mark.parametrize("capacity", [2048, 300])
def test_documents(spark, capacity):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    used, least = checked(packing.pack(docs, PATH, capacity, 500).collect(), [tuple(r) for r in docs.collect()], capacity)
    assert used <= (least + 1 if capacity == 2048 else 1.01 * least)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (None, "a b"), (4, "same"), (4, "same"), (5, "word " * 9_000)]
    rows += [(6, " "), (7, "é Été ΣΣ ǅ 你好 <|endoftext|>x 'S 'll\x1cz"), (8, "x" * 300)]
    rows += [(9, " ".join("abc"[: i % 3 + 1] for i in range(9)))]
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, length int, uid int")
    checked(packing.pack(docs.repartition(3), PATH, 16, 4).collect(), rows, 16)
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_sequences_hold_the_ids(spark):
    rows = [(i, "some words of text " * (i % 40)) for i in range(300)]
    got = packing.sequences(spark.createDataFrame(rows, "doc_id long, text string"), PATH, 128, 50).collect()
    told = defaultdict(int)
    for r in got:
        assert len(r.ids) <= 128
        for d, n in zip(r.doc_ids, np.diff([-1, *np.flatnonzero(np.array([*r.ids[:-1], 0]) == 0)]), strict=False):
            told[d] += int(n)
    assert sum(told.values()) == sum(len(PLAIN.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    assert {d for r in got for d in r.doc_ids} == set(range(300))


@given(st.lists(st.text(max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_texts_give_the_plain_ids(texts):
    encoder = ENCODER
    for _ in range(2):
        for text, ids in zip(texts, encoder.ids_of(texts), strict=True):
            assert ids.tolist() == PLAIN.encode(text, add_special_tokens=False).ids


@given(st.lists(st.text(st.characters(max_codepoint=255) | st.sampled_from("'stremvld <|½²\xa0\x85\x1c"), max_size=30), max_size=6))
@settings(max_examples=300, deadline=None)
def test_latin_texts_give_the_plain_ids(texts):
    encoder = ENCODER
    assert encoder.latin
    for text, ids in zip(texts, encoder.ids_of(texts), strict=True):
        assert ids.tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_rule_against_plain_statement():
    rng = np.random.default_rng(4)
    for _ in range(40):
        lengths, capacity = rng.integers(1, 13, 40), 12
        free, want = [], []
        for s in sorted(lengths, reverse=True):
            def total(gaps):
                return sum(gaps.count(g) ** 2 for g in range(1, capacity))
            tries = [(total(free[:k] + [g - s] + free[k + 1:]), g, k) for k, g in enumerate(free) if g >= s]
            if tries:
                k = min(tries)[2]
                free[k] -= s
            else:
                free.append(capacity - s)
            want.append(sorted(free))
        sequence, offset = packing.squares_packing(lengths, capacity)
        filled = np.bincount(sequence, lengths)
        assert filled.max() <= capacity
        assert sorted(capacity - filled) == want[-1]
        for n in range(len(filled)):
            own = np.flatnonzero(sequence == n)
            order = own[np.argsort(offset[own])]
            assert offset[order].tolist() == np.append(0, np.cumsum(lengths[order])[:-1]).tolist()


