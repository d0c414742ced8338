"""Best-fit packing of tokenised documents into sequences by the sum-of-squares rule.

Documents are tokenised once, in tasks, and cut only where they are longer than a sequence.
Their pieces are dealt at random to groups of a few thousand, which all have nearly the same
mix of lengths, and every group packs its own: longest piece first, each placed where the sum
of N(g)^2 becomes smallest, N(g) being the number of open sequences with g free places; a new
sequence is opened only for a piece that fits nowhere. What a group leaves with much free space,
a sequence or so, is opened again and packed with the leavings of the other groups.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from calipers.llm.common import by_size, stored, text_of
from calipers.runtime import ship

CAPACITY = 2048
#: The id at the end of every document.
END = 0
#: Pieces of a group, on average.
GROUP = 4096
#: Sequences with more free places than this part of the capacity are opened again.
POOR = 1 / 16
#: The encoder keeps the ids of so many words, of so many letters at most.
KEPT_WORDS, KEPT_LETTERS = 400_000, 64

_PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


# How the word tokenizer prepares a text, as its definition states it.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for lower-case text of the first 256 characters, all of which are stable under NFC; letters first.
_LATIN = re.compile(
    "[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+"
)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: visible ones for themselves, the others for letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class Encoder:
    """Token ids of many texts.

    Words recur, and the ids of a text are those of its words. So texts of Latin letters are cut into words
    here, and the tokenizer's model gets each word once. Other texts go through the whole tokenizer.
    """

    def __init__(self, tokenizer: str) -> None:
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.letters = byte_letters()
        stated = json.loads(tokenizer)
        normal, split = (stated.get(k) or {} for k in ("normalizer", "pre_tokenizer"))
        first, *rest = split.get("pretokenizers") or [{}]
        self.latin = normal.get("normalizers") == _NORMALIZER and (
            first.get("pattern"), first.get("behavior"), first.get("invert"), [(r.get("type"), r.get("add_prefix_space"), r.get("use_regex")) for r in rest]
        ) == ({"Regex": _SPLIT}, "Removed", True, [("ByteLevel", False, False)])

    def _word(self, word: str) -> bytes:
        spelt = word if word.isascii() and word.isalpha() else "".join(map(self.letters.__getitem__, word.encode()))
        ids = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        if len(word) <= KEPT_LETTERS:
            self.words[word] = ids
        return ids

    def _cut(self, text: str) -> list[str] | None:
        """The words of a text of the first 256 characters without special tokens; None for other texts."""
        if not self.latin or "<|" in text:
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return _LATIN.findall(text.lower())

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text as unsigned 32-bit numbers."""
        words: list[str] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        others = {}
        for i, text in enumerate(texts):
            if (own := self._cut(text)) is None:
                others[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
            else:
                counts[i] = len(own)
                words += own
        cells = np.empty(len(words), dtype=object)
        cells[:] = words
        number, forms = pd.factorize(cells)
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        parts = list(map(self.words.get, forms))
        for i in [i for i, ids in enumerate(parts) if ids is None]:
            parts[i] = self._word(forms[i])
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        first = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(parts), dtype="<u4")
        own = sizes[number]
        ends = np.append(0, np.cumsum(own))
        ids = ids[np.repeat(first[number] - ends[:-1], own) + np.arange(ends[-1])]
        bounds = ends[np.append(0, np.cumsum(counts))]
        return [others[i] if i in others else ids[bounds[i]: bounds[i + 1]] for i in range(len(texts))]


_ENCODERS: dict[int, Encoder] = {}


def _encoder(tokenizer: str) -> Encoder:
    """One encoder for each tokenizer and Python worker, so that later tasks find its words."""
    key = hash(tokenizer)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(tokenizer)
    return _ENCODERS[key]


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32 (and with `ids` the ids as an array) of every piece of every row."""
    ship(docs.sparkSession)
    definition = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    schema = _PIECES + ", ids array<int>" * ids
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * ids]
    names = [column.split()[0] for column in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        uid = TaskContext.get().partitionId() << 36
        for part in by_size(batches, 4 << 20):
            rows = []
            for doc_id, own in zip(part.column("doc_id").to_pylist(), encoder.ids_of(part.column("text").to_pylist()), strict=True):
                own = np.append(own, np.uint32(END)).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    cut = own[start: start + capacity]
                    rows.append((uid, doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes()), *[cut.astype(np.int32)] * ids))
                    uid += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)], names
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return texts.mapInArrow(run, schema)


def squares_packing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece and its offset there; sequences are numbered from 0.

    Longest first. A piece of s ids goes to the open sequences with the number g of free places
    for which the sum of squares grows least: by 2 (N(g - s) - N(g)) + 2, or, where it fills
    one up (g = s), by 1 - 2 N(g). Ties go to the fuller sequence.
    """
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    squares = np.zeros(capacity + 1, dtype=np.int64)  # N(g)
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    never = np.iinfo(np.int64).max
    used = 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        there = squares[s:]
        growth = np.where(there > 0, 2 * (squares[: len(there)] - there) + 2, never)
        if there[0]:
            growth[0] = 1 - 2 * there[0]
        g = s + int(np.argmin(growth))
        if growth[g - s] == never:
            g, n = capacity, used
            used += 1
        else:
            n = open_[g].pop()
            squares[g] -= 1
        sequence[i], offset[i] = n, capacity - g
        if g > s:
            squares[g - s] += 1
            open_[g - s].append(n)
    return sequence, offset


def _placed(pieces: DataFrame, groups: int, level: int, capacity: int) -> DataFrame:
    """Pieces with sequence_id, offset and the free places of their sequence."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", ignore_index=True)  # the same packing whenever a task runs again
        lengths = rows["length"].to_numpy()
        sequence, offset = squares_packing(lengths, capacity)
        free = capacity - np.bincount(sequence, lengths).astype(np.int64)
        return rows.drop(columns="grp").assign(
            sequence_id=((level << 24 | key[0]) << 32) + sequence, offset=offset, free=free[sequence]
        )

    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.lit(level), "uid"), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(run, _PIECES + ", sequence_id long, offset long, free long")


def _groups(pieces: DataFrame, group: int) -> int:
    return max(1, math.ceil(pieces.count() / group))


def placements(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """sequence_id and offset of every piece; pieces are those of `pieces_of`, from a written table.

    Pieces that fill a sequence stand alone in one with a negative number.
    """
    pieces = pieces.select("uid", "doc_id", "piece", "start", "length", "ids_crc32")
    whole = pieces.where(F.col("length") >= capacity).select(
        *pieces.columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < capacity)
    first = stored(_placed(rest, _groups(rest, group), 0, capacity), "packed")
    poor = F.col("free") > int(capacity * POOR)
    again = first.where(poor).select(*pieces.columns)
    second = _placed(again, _groups(again, group), 1, capacity)
    return whole.unionByName(first.where(~poor).drop("free")).unionByName(second.drop("free"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row; docs: doc_id, text.

    `tokenizer` is the path of a definition for the tokenizers library. Every document ends with id 0. A null or empty text is that id alone, and
    so is one without tokens. Repeated rows and null ids are packed like others. Texts of any length
    are cut into pieces of `capacity` ids. Equal lengths: any of them first. No rows: no rows.
    """
    pieces = stored(pieces_of(docs, tokenizer, capacity), "pieces")
    return placements(pieces, capacity, group).drop("uid")


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """sequence_id, ids, doc_ids of the training sequences: the ids of its pieces in order of their offsets, and their documents."""
    pieces = stored(pieces_of(docs, tokenizer, capacity, ids=True), "pieces")
    placed = placements(pieces, capacity, group).select("uid", "sequence_id", "offset")
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most `capacity` pieces
    return pieces.select("uid", "doc_id", "ids").join(placed, "uid").groupBy("sequence_id").agg(inside.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
