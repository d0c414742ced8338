"""Removal of repeated passages by suffix order and longest previous factors, over chunks of a corpus.

A byte is removed when a string of SPAN bytes that covers it also starts in a document with a
smaller id. Whether the string at a position has an earlier occurrence is what a longest-
previous-factor array says: in suffix order, the nearest suffixes with a smaller document
before and after (previous and next smaller values) hold the longest earlier match.

One suffix array of a whole corpus cannot be built in tasks, and most positions need none.
So the corpus is cut into chunks of documents, and three exchanges, each by hash and each
of one entry per chunk and value at most, narrow down what has to be sorted:

1. Every window of SPAN bytes has an anchor, the least hash of its GRAM-byte strings. Equal
   windows have equal anchors, so windows whose anchor occurs once in the corpus are done.
2. Neighbouring windows with one anchor form a unit. A unit whose text stands in an earlier
   document is removed whole. Units that are the only text around their anchor are done.
3. What is left are the ends of repeats. The distinct texts of these units are sent to the groups of
   their anchors, where all windows of an anchor meet. There the windows, suffixes cut at SPAN bytes, are
   put in suffix order and resolved by longest previous factors.

So nothing is limited: a passage that stands in a third of all documents sends an entry per
chunk, and a chunk's memory is bounded by its bytes (about 100 bytes each) or its longest
document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import stored_by, text_of
from calipers.llm.words import mixed, powers
from calipers.runtime import checkpointed, ship

SPAN, GRAM = 50, 24
#: Windows that a group puts in suffix order at once, as far as their anchors differ.
TOGETHER = 250_000
#: Bytes of text in a chunk, and of corpus for each group of exchanged hashes.
CHUNK_BYTES, GROUP_BYTES = 2_000_000, 16_000_000
#: Null ids come after all others and do not precede each other.
NULL_ID = 2**63 - 1

_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _packed(values: np.ndarray, level: int = 1) -> bytes:
    """Compressed, all first bytes before all second ones: ids and ascending keys differ little in some of them."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return values.nbytes.to_bytes(8, "little") + pa.Codec("zstd", level).compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def chunks_of(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """uid, ids, sizes, data: documents in bunches of about `chunk_bytes`, compressed, spread by uid."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uid = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        parts: list[bytes] = []
        size = 0

        def chunk() -> pd.DataFrame:
            return pd.DataFrame({
                "uid": [uid], "ids": [_packed(np.array(ids, dtype=np.int64))],
                "sizes": [_packed(np.array([len(p) for p in parts], dtype=np.int64))],
                "data": [_packed(np.frombuffer(b"".join(parts), dtype=np.uint8), 9)],
            })

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True):
                ids.append(doc_id)
                parts.append(text.encode("utf-8", "surrogatepass"))
                size += len(parts[-1])
                if size >= chunk_bytes or len(ids) >= chunk_bytes // 8:
                    yield chunk()
                    uid, ids, parts, size = uid + 1, [], [], 0
        if ids:
            yield chunk()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), text_of(F.col("text")).alias("text")
    )
    return rows.mapInPandas(run, "uid long, ids binary, sizes binary, data binary")


@dataclass
class Chunk:
    ids: np.ndarray  # of the documents
    data: np.ndarray
    offsets: np.ndarray  # of the documents in data, one more
    start: np.ndarray  # of each unit: its first window,
    length: np.ndarray  # the number of its windows,
    anchor: np.ndarray  # its anchor
    doc: np.ndarray  # and its document's number in the chunk

    @cached_property
    def sums(self) -> np.ndarray:
        """Prefix sums of a polynomial hash."""
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        values = self.data.astype(np.uint64)
        values += np.uint64(1)
        values *= _powers(_BASE, len(values))
        np.cumsum(values, out=sums[1:])
        return sums

    def hashes(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte strings that begin at `begin`."""
        own = (self.sums[begin + size] - self.sums[begin]) * _powers(_BASE_INVERSE, len(self.data))[begin]
        return mixed(own + np.asarray(size).astype(np.uint64) * _C2)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers; the longest run so far is kept for the next chunk."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = powers(base, n)
    return _POWERS[base][:n]


def opened(ids: bytes, sizes: bytes, data: bytes) -> Chunk:
    doc_ids, lengths, text = _unpacked(ids, "<i8"), _unpacked(sizes, "<i8"), _unpacked(data, "u1")
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    n = len(text)
    none = np.zeros(0, dtype=np.int64)
    if n < SPAN:
        return Chunk(doc_ids, text, offsets, none, none, none.astype(np.uint64), none)
    raw = text.tobytes()
    eight = np.ndarray((n - 7,), "<u8", raw, 0, (1,))
    least = np.zeros(n - GRAM + 1, dtype=np.uint64)
    for at in range(0, GRAM, 8):  # GRAM bytes to 64 bits, in place
        least += eight[at: at + len(least)] * _C2
        least *= _C1
        least ^= least >> np.uint64(29 + at // 8)
    least *= _C2
    reach = 1
    while reach * 2 <= SPAN - GRAM + 1:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = SPAN - GRAM + 1 - reach
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    # a unit ends where the anchor changes, and where the windows of its document end
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    begins = offsets[:-1][lengths >= SPAN]
    stops = offsets[1:][lengths >= SPAN] - SPAN + 1
    start = np.sort(np.concatenate([change, begins]))
    start = start[np.append(True, start[1:] != start[:-1])[: len(start)]]
    doc = np.searchsorted(offsets, start, side="right") - 1
    last = offsets[doc + 1] - SPAN + 1
    end = np.minimum(np.append(start[1:], stops[-1:] if len(stops) else 0), last)
    whole = np.flatnonzero(end > start)
    start, doc = start[whole], doc[whole]
    return Chunk(doc_ids, text, offsets, start, end[whole] - start, least[start], doc)


def _least_id(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the least id of each, and the number of every row's key."""
    if not len(keys):
        return keys, ids, np.zeros(0, dtype=np.int64)
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], np.minimum.reduceat(ids[order], np.flatnonzero(new)), number


def _by_group(keys: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the ascending keys by group, and where the groups begin."""
    group = (keys % np.uint64(groups)).astype(np.int16 if groups < 2**15 else np.int64)
    order = np.argsort(group, kind="stable")
    return order, np.searchsorted(group[order], np.arange(groups + 1))


def _messages(keys: np.ndarray, groups: int, kind: int, *columns: np.ndarray) -> list[tuple]:
    """(group, kind, packed columns...) for every group that has keys."""
    order, bounds = _by_group(keys, groups)
    out = []
    for g in range(groups):
        part = order[bounds[g]: bounds[g + 1]]
        if len(part):
            out.append((g, kind, *(_packed(c[part]) for c in columns)))
    return out


def _answers(keys: np.ndarray, groups: int, kind: int, replies: list) -> np.ndarray:
    """The replies of the groups, put back to the keys."""
    order, bounds = _by_group(keys, groups)
    out = np.zeros(len(keys), dtype=bool)
    for reply in replies or []:
        if reply["kind"] == kind:
            part = order[bounds[reply["grp"]]: bounds[reply["grp"] + 1]]
            out[part] = np.unpackbits(_unpacked(reply["bits"], "u1"), count=len(part)).astype(bool)
    return out


# Exchange 1: anchors. A key is the anchor's upper half and its group; one entry per chunk.


def _anchor_keys(chunk: Chunk, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a chunk's anchors, and the number of each unit's key."""
    coarse = (chunk.anchor >> np.uint64(32)) * np.uint64(groups) + chunk.anchor % np.uint64(groups)
    return np.unique(coarse, return_inverse=True)


def _anchors(chunk: Chunk, groups: int) -> list[tuple]:
    keys, _ = _anchor_keys(chunk, groups)
    return _messages(keys, groups, 0, (keys // np.uint64(groups)).astype(np.uint32))


def _in_many(rows: pd.DataFrame) -> list[np.ndarray]:
    held = [_unpacked(d, "<u4") for d in rows["a"]]
    values = np.concatenate(held)
    distinct, times = np.unique(values, return_counts=True)
    many = distinct[times > 1]
    return [_among(h, many) for h in held]


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


# Exchange 2: units by text (is there an earlier one), and anchors by the texts around them (is there another one).


@dataclass
class Units:
    shared: np.ndarray  # numbers of the units whose anchor occurs elsewhere
    texts: np.ndarray  # distinct hashes of their texts
    least: np.ndarray  # the least document id of each
    text: np.ndarray  # the number of each shared unit's text
    anchors: np.ndarray  # distinct keys of anchors
    low: np.ndarray  # a text hash of each
    many: np.ndarray  # and whether the chunk has several
    anchor: np.ndarray  # the number of each shared unit's anchor


def units_of(chunk: Chunk, groups: int, replies: list) -> Units:
    keys, number = _anchor_keys(chunk, groups)
    elsewhere = _answers(keys, groups, 0, replies)
    times = np.bincount(number, minlength=len(keys))
    shared = np.flatnonzero((elsewhere | (times > 1))[number]) if len(number) else number
    hashes = chunk.hashes(chunk.start[shared], chunk.length[shared] + SPAN - 1)
    texts, least, text = _least_id(hashes, chunk.ids[chunk.doc[shared]])
    anchors, place = np.unique(number[shared], return_inverse=True)
    low = np.full(len(anchors), 2**64 - 1, dtype=np.uint64)
    high = np.zeros(len(anchors), dtype=np.uint64)
    np.minimum.at(low, place, hashes)
    np.maximum.at(high, place, hashes)
    return Units(shared, texts, least, text, keys[anchors], low, low != high, place)


def _units(chunk: Chunk, groups: int, replies: list) -> list[tuple]:
    u = units_of(chunk, groups, replies)
    short = (u.anchors // np.uint64(groups)).astype(np.uint32)
    return _messages(u.texts, groups, 1, u.texts, u.least) + _messages(u.anchors, groups, 2, short, u.low, u.many)


def _earlier(rows: pd.DataFrame) -> list[np.ndarray]:
    """Whether another chunk holds the same value in a document with a smaller id."""
    values = [_unpacked(d, "<u8") for d in rows["a"]]
    ids = [_unpacked(d, "<i8") for d in rows["b"]]
    distinct, least, _ = _least_id(np.concatenate(values), np.concatenate(ids))
    return [least[np.searchsorted(distinct, v)] < i for v, i in zip(values, ids, strict=True)]


def _varied(rows: pd.DataFrame) -> list[np.ndarray]:
    """Whether an anchor has more than one text around it."""
    values = [_unpacked(d, "<u4") for d in rows["a"]]
    low = np.concatenate([_unpacked(d, "<u8") for d in rows["b"]])
    distinct, number = np.unique(np.concatenate(values), return_inverse=True)
    least = np.full(len(distinct), 2**64 - 1, dtype=np.uint64)
    np.minimum.at(least, number, low)
    varied = np.zeros(len(distinct), dtype=bool)
    varied[number[(low != least[number]) | np.concatenate([_unpacked(d, "?") for d in rows["c"]])]] = True
    return [varied[np.searchsorted(distinct, v)] for v in values]


# Exchange 3: windows at the ends of repeats.


def smaller_neighbours(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest place before, and after, with a smaller value; -1 and len where there is none."""
    n = len(values)

    def before(v: np.ndarray) -> np.ndarray:
        out = np.arange(n) - 1
        bound = np.append(v, np.iinfo(np.int64).min)  # place -1 is below everything
        open_ = np.flatnonzero(bound[out] >= v)
        while len(open_):
            out[open_] = out[out[open_]]
            open_ = open_[bound[out[open_]] >= v[open_]]
        return out

    return before(values), n - 1 - before(values[::-1])[::-1]


def earlier_factors(data: np.ndarray, begin: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For windows of SPAN bytes at `begin`: the number of its text, and whether its longest previous factor has SPAN bytes.

    The windows are put in suffix order (as far as SPAN bytes, then by document). A window
    has an earlier match of SPAN bytes when the previous or next smaller document in that
    order stands among its equals.
    """
    if not len(begin):
        return begin, np.zeros(0, dtype=bool)
    padded = np.zeros((len(begin), 56), dtype=np.uint8)
    padded[:, :SPAN] = np.lib.stride_tricks.sliding_window_view(data, SPAN)[begin]
    words = padded.view(">u8")
    head, *tail = (words[:, i].astype(np.uint64) for i in range(7))
    order = np.argsort(head)
    same = head[order][1:] == head[order][:-1]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))  # only these need the other bytes
    own = order[tied]
    order[tied] = own[np.lexsort((ids[own], *(c[own] for c in tail[::-1]), head[own]))]
    new = np.ones(len(begin), dtype=bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in (head, *tail)], axis=0)
    equal = np.cumsum(new) - 1
    previous, following = smaller_neighbours(ids[order])
    padded = np.append(equal, -1)  # one past the end, and -1, belong to no text
    matched = (padded[previous] == equal) | (padded[following] == equal)
    text, found = np.empty(len(begin), dtype=np.int64), np.empty(len(begin), dtype=bool)
    text[order], found[order] = equal, matched
    return text, found


@dataclass
class Ends:
    units: np.ndarray  # that need a look
    text: np.ndarray  # the number of each one's text
    anchor: np.ndarray  # of each text: its anchor's key,
    least: np.ndarray  # the least document id,
    start: np.ndarray  # a place where it stands,
    length: np.ndarray  # and the number of its windows
    removed: np.ndarray  # units that are removed whole


def ends_of(chunk: Chunk, groups: int, first: list, second: list) -> Ends:
    u = units_of(chunk, groups, first)
    if not len(u.shared):
        none = np.zeros(0, dtype=np.int64)
        return Ends(none, none, none.astype(np.uint64), none, none, none, none)
    own = chunk.ids[chunk.doc[u.shared]]
    gone = (own > u.least[u.text]) | _answers(u.texts, groups, 1, second)[u.text]
    varied = _answers(u.anchors, groups, 2, second) | u.many
    look = np.flatnonzero(~gone & varied[u.anchor])
    texts, place, text = np.unique(u.text[look], return_index=True, return_inverse=True)
    of_text = u.shared[look[place]]
    key = u.anchors[u.anchor[look[place]]]
    order = np.argsort(key, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    of_text = of_text[order]
    return Ends(u.shared[look], rank[text], key[order], u.least[texts[order]], chunk.start[of_text], chunk.length[of_text], u.shared[gone])


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for each stretch, one after the other."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


def _windows(chunk: Chunk, groups: int, first: list, second: list) -> list[tuple]:
    e = ends_of(chunk, groups, first, second)
    order, bounds = _by_group(e.anchor, groups)
    short = (e.anchor // np.uint64(groups)).astype(np.uint32)
    out = []
    for g in range(groups):
        part = order[bounds[g]: bounds[g + 1]]
        if len(part):
            data = chunk.data[_ragged(e.start[part], e.length[part] + SPAN - 1)]
            out.append((g, 3, _packed(short[part]), _packed(e.least[part]), _packed(e.length[part].astype(np.uint32)), _packed(data)))
    return out


def _repeated(rows: pd.DataFrame) -> list[np.ndarray]:
    """For each window of each text sent, whether a document with a smaller id has it."""
    held = [[_unpacked(d, kind) for d in rows[c]] for c, kind in (("a", "<u4"), ("b", "<i8"), ("c", "<u4"), ("d", "u1"))]
    anchor, ids, length, data = (np.concatenate(x) for x in held)
    length = length.astype(np.int64)
    start = np.cumsum(length + SPAN - 1) - (length + SPAN - 1)
    first = np.cumsum(length) - length  # of each text's windows among all
    order = np.argsort(anchor, kind="stable")
    sums = np.cumsum(length[order])
    ends = np.flatnonzero(np.append(anchor[order][1:] != anchor[order][:-1], True)) + 1  # where an anchor's texts end
    out = np.zeros(int(length.sum()), dtype=bool)
    begin = 0
    while begin < len(order):
        done = sums[begin - 1] if begin else 0
        end = ends[min(np.searchsorted(sums[ends - 1], done + TOGETHER, side="right"), len(ends) - 1)]
        part = order[begin:end]
        _, matched = earlier_factors(data, _ragged(start[part], length[part]), np.repeat(ids[part], length[part]))
        out[_ragged(first[part], length[part])] = matched
        begin = end
    counts = [int(c.sum()) for c in held[2]]
    return np.split(out, np.cumsum(counts)[:-1])


def removed_bytes(chunk: Chunk, groups: int, first: list, second: list, third: list) -> np.ndarray:
    e = ends_of(chunk, groups, first, second)
    order, bounds = _by_group(e.anchor, groups)
    at = np.cumsum(e.length) - e.length  # of each text's windows
    repeated = np.zeros(int(e.length.sum()), dtype=bool)
    for reply in third or []:
        part = order[bounds[reply["grp"]]: bounds[reply["grp"] + 1]]
        own = _ragged(at[part], e.length[part])
        repeated[own] = np.unpackbits(_unpacked(reply["bits"], "u1"), count=len(own)).astype(bool)
    size = e.length[e.text]
    hit = _ragged(chunk.start[e.units], size)[repeated[_ragged(at[e.text], size)]]
    marks = np.zeros(len(chunk.data) + 1, dtype=np.int32)
    np.add.at(marks, hit, 1)
    np.add.at(marks, hit + SPAN, -1)
    np.add.at(marks, chunk.start[e.removed], 1)
    np.add.at(marks, chunk.start[e.removed] + chunk.length[e.removed] + SPAN - 1, -1)
    return np.cumsum(marks[:-1]) > 0


_MESSAGE = "uid long, grp int, kind int, a binary, b binary, c binary, d binary"
_REPLY = "uid long, grp int, kind int, bits binary"
_REPLIERS: dict[int, Callable[[pd.DataFrame], list[np.ndarray]]] = {0: _in_many, 1: _earlier, 2: _varied, 3: _repeated}


def _exchange(
    chunks: DataFrame, ask: Callable[..., list[tuple]], groups: int, parts: int, name: str, rounds: list[str]
) -> DataFrame:
    """Each chunk asks every group of hashes; each group answers with a bit per entry. Adds the answers as a column."""
    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                sent = ask(opened(row["ids"], row["sizes"], row["data"]), groups, *(_listed(row[r]) for r in rounds))
                yield pd.DataFrame(
                    [(row["uid"], g, kind, *columns, *[None] * (4 - len(columns))) for g, kind, *columns in sent],
                    columns=["uid", "grp", "kind", "a", "b", "c", "d"],
                )

    def answered(rows: pd.DataFrame) -> pd.DataFrame:
        bits = _REPLIERS[int(rows["kind"].iloc[0])](rows)
        out = rows[["uid", "grp", "kind"]].copy()
        out["bits"] = [_packed(np.packbits(b)) for b in bits]
        return out

    sent = chunks.mapInPandas(asked, _MESSAGE).repartition(parts, "grp", "kind")
    replies = sent.groupBy("grp", "kind").applyInPandas(answered, _REPLY).repartition(parts, "uid")
    listed = checkpointed(replies.groupBy("uid").agg(F.collect_list(F.struct("grp", "kind", "bits")).alias(name)))
    return chunks.join(listed, "uid", "left")


def _listed(value: object) -> list:
    return [] if value is None else list(value)


def trimmed(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, group_bytes: int = GROUP_BYTES, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and with `texts` kept, the bytes that stay) of every row of docs.

    Null text counts as empty; texts under 50 bytes lose nothing. Repeats inside a document
    or between rows of one doc_id stay. Null doc_id: after all others, and the rows do not
    precede each other. No rows: no rows.
    """
    ship(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    groups = max(16, math.ceil(total / group_bytes))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(tasks, math.ceil(total / 16_000_000))
    chunks = stored_by(chunks_of(docs, chunk_bytes), "chunks", "uid", parts)
    with_anchors = _exchange(chunks, _anchors, groups, parts, "first", [])
    with_units = _exchange(with_anchors, _units, groups, parts, "second", ["first"])
    with_windows = _exchange(with_units, _windows, groups, parts, "third", ["first", "second"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                chunk = opened(row["ids"], row["sizes"], row["data"])
                gone = removed_bytes(chunk, groups, *(_listed(row[r]) for r in ("first", "second", "third")))
                rows = []
                for i, doc_id in enumerate(chunk.ids.tolist()):
                    a, b = chunk.offsets[i], chunk.offsets[i + 1]
                    own = gone[a:b]
                    kept = chunk.data[a:b][~own].tobytes()
                    begins = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
                    rows.append((
                        None if doc_id == NULL_ID else doc_id, int(b - a), int(own.sum()), begins,
                        hashlib.sha256(kept).hexdigest(), *([kept] if texts else []),
                    ))
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])]
                yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return with_windows.mapInPandas(run, schema)
