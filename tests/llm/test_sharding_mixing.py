import zlib

import pytest
from pyspark.sql import types as T

from calipers.llm import mixing, sharding

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def plain_jump(key: int, shards: int) -> int:
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


ODD = [
    (7, "same", "en", "a", 4), (7, "same", "en", "a", 4), (None, None, None, None, None), (None, "", "en", "b", 0),
    (-3, "é" * 50_000, "fr", "a", 1), (2**62, "x y", "en", None, 3), (0, "a b c\n d", "en", "b", 7),
]


def test_shards(spark):
    rows = ODD + [(i, f"text {i}", "en", "a", 6) for i in range(10, 600)]
    docs = spark.createDataFrame(rows, DOCS)
    got = sharding.place(docs, 8, rows_per_piece=40).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        key = -1 if r.row.doc_id is None else r.row.doc_id
        data = (r.row.text or "").encode()
        assert (r.shard, r.grown_shard) == (plain_jump(key, 8), plain_jump(key, 9))
        assert r.grown_shard in (r.shard, 8)
        assert (r["size"], r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        slots.setdefault(r.shard, []).append((r.slot, r.row.doc_id if r.row.doc_id is not None else -(2**63)))
    for pairs in slots.values():
        assert [s for s, _ in sorted(pairs)] == list(range(len(pairs)))
        ids = [i for _, i in sorted(pairs)]
        assert ids == sorted(ids)


def test_shards_of_nothing_and_clashing_columns(spark):
    none = spark.createDataFrame([], DOCS)
    assert sharding.shard_rows(none).count() == 0
    extra = spark.createDataFrame([(1, "t", 5, 6)], "doc_id long, text string, shard int, size int")
    assert sharding.shard_documents(extra).columns == ["doc_id", "text", "shard", "size", "shard_of_8", "slot"]


def plain_targets(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if share[s] > 3 * sizes[s]]
        if not above:
            return full | share
        full |= {s: 3.0 * sizes[s] for s in above}


def test_mix_against_plain_resharing(spark):
    rows = ODD + [(i, "w " * (i % 17), "en", f"s{i % 5 if i % 3 else 0}", 0) for i in range(10, 900)]
    rows += [(2000 + i, "one two", "en", "tiny", 7) for i in range(3)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.takes(docs, rows_per_piece=50).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        s = r.row.source
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert r.taken <= 3 * r["size"]
        assert len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions)
    want = plain_targets(sizes)
    longest = {s: max(r["size"] for r in got if r.row.source == s) for s in sizes}
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, mixing.takes(docs.repartition(7), rows_per_piece=50).collect()))


def test_order_follows_the_schedule(spark):
    docs = spark.createDataFrame([(i, "a b c", "en", f"s{i % 3}", 5) for i in range(3000)], DOCS)
    got = [r.source for r in mixing.training_order(docs).collect()]
    early, late = got[: len(got) // 4], got[-len(got) // 4:]
    assert early.count("s0") > 1.5 * late.count("s0") and late.count("s2") > 1.2 * early.count("s2")
    assert mixing.training_order(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mix_rows(spark.createDataFrame([], DOCS)).count() == 0


def test_free_names_of_shards(spark):
    docs = spark.createDataFrame([(1, "a", 5, 6, 7)], "doc_id long, text string, shard int, shard_of_8 int, SLOT int")
    assert sharding.shard_documents(docs).columns == ["doc_id", "text", "shard", "shard_of_8", "SLOT", "shard_of_8_2", "slot_of_8"]
