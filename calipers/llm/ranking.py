"""Ranked lexical search by the Best Position Algorithm over impact lists.

Documents are indexed in blocks: for every term of the items, the documents of the block that hold it
and how often. The sums over all blocks (documents, terms, documents of each term) give every entry its
impact, what it adds to a score. In each block the lists of an item's terms are sorted by impact and
read side by side from the top. A document met in one list is looked up in all others at once (direct
accesses), which gives its score and marks its places in them as seen. In each list the best
position is the end of the seen places that have no gap; no document without a score yet can have more
there than the next entry. As soon as the sum of these bounds is strictly below the k-th score found so far, in
this block or in those the task searched before, the rest of the block cannot change the result.

Items are searched in batches of a bounded size, so that neither the driver nor a task holds more than
a batch of them, however many there are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calipers.llm.common import by_size, stored, text_of
from calipers.runtime import ship

# What a term consists of, in a text with A-Z in lower case.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TOP = 50
#: Bytes of text in a block of the index, and of items in a batch.
BLOCK_BYTES, BATCH_BYTES = 16_000_000, 8_000_000
#: Places read from each list at first; each time twice as many.
FIRST_READ = 32
#: The tops of the tasks are merged in so many bunches first.
BUNCHES = 256
#: Null ids come last.
NULL_ID = 2**63 - 1

_INDEX = (
    "n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<int>, counts array<int>, "
    "holders array<int>, times array<int>"
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order; only A-Z are lower-cased."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower())


@dataclass
class Items:
    """A batch of items: `terms` holds the numbers of item i's terms from first[i] to first[i + 1]."""

    ids: list
    first: np.ndarray
    terms: np.ndarray
    numbers: dict[bytes, int]


def items_of(rows: list[tuple]) -> Items:
    """Rows (item_id, text); rows of one id are one item. Every term counts once."""
    of_item: dict[object, set[bytes]] = {}
    for item_id, text in rows:
        of_item.setdefault(item_id, set()).update(terms_of(text))
    numbers: dict[bytes, int] = {}
    listed = [[numbers.setdefault(t, len(numbers)) for t in sorted(own)] for own in of_item.values()]
    first = np.cumsum([0, *map(len, listed)])
    return Items(list(of_item), first, np.array([t for own in listed for t in own], dtype=np.int64), numbers)


def index(docs: DataFrame, vocabulary: Broadcast, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each block: its counts, and per term of the vocabulary the holding documents, ascending, and how often each holds it."""
    types = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.int32())] * 4]
    names = [column.split()[0] for column in _INDEX.split(", ")]

    def block(parts: list[tuple]) -> pa.RecordBatch:
        ids, lengths, holders, terms, times, n_docs, n_terms = zip(*parts, strict=True)
        shift = np.cumsum([0, *map(len, ids[:-1])])
        holder = np.concatenate([h + s for h, s in zip(holders, shift, strict=True)])
        term = np.concatenate(terms)
        order = np.lexsort((holder, term))
        own, counts = np.unique(term, return_counts=True)
        values = [sum(n_docs), sum(n_terms), np.concatenate(ids), np.concatenate(lengths), own, counts, holder[order], np.concatenate(times)[order]]
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        parts: list[tuple] = []
        size = 0
        for part in by_size(batches):
            length, own, held = [], [], []
            for text in part.column("text").to_pylist():
                terms = terms_of(text)
                length.append(len(terms))
                found = [t for t in map(number, terms) if t is not None]
                own += found
                held.append(len(found))
            n = np.array(length, dtype=np.int64)
            entries = np.repeat(np.arange(len(n)), held) * (len(vocabulary.value) + 1) + np.array(own, dtype=np.int64)
            entries, times = np.unique(entries, return_counts=True)
            doc, term = np.divmod(entries, len(vocabulary.value) + 1)
            kept, doc = np.unique(doc, return_inverse=True)  # only documents with a term of some item
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)[kept]
            parts.append((ids, n[kept], doc, term, times, int((n > 0).sum()), int(n.sum())))
            size += part.column("text").nbytes
            if size >= block_bytes:
                yield block(parts)
                parts, size = [], 0
        if parts:
            yield block(parts)

    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), text_of(F.col("text")).alias("text")
    )
    return texts.mapInArrow(run, _INDEX)


@dataclass
class Block:
    """The impact lists of a block's terms. Entries stand by term and document; a list's ranks count from its begin."""

    ids: np.ndarray  # of the documents
    begin: np.ndarray  # of each term's entries, one more
    key: np.ndarray  # of each entry: term and document in one ascending number,
    impact: np.ndarray  # what it adds to the score,
    place: np.ndarray  # and its rank in its list
    doc: np.ndarray  # of each rank
    falling: np.ndarray  # impact of each rank

    @classmethod
    def of(cls, row: dict, weight: np.ndarray, n: int, total: int) -> tuple[np.ndarray, Block]:
        """The block's terms, ascending, and their lists; weight: of each term; n documents with `total` terms in all blocks."""
        terms = row["terms"]
        begin = np.append(0, np.cumsum(row["counts"], dtype=np.int64))
        number = np.repeat(np.arange(len(terms)), row["counts"])
        doc, tf = row["holders"].astype(np.int64), row["times"].astype(np.int64)
        m = 50 + (50 * row["lengths"] * n) // max(1, total)
        impact = weight[terms][number] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.lexsort((-impact, number))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order)) - begin[number]
        return terms, cls(row["doc_ids"], begin, number * len(row["doc_ids"]) + doc, impact, place, doc[order], impact[order])


@dataclass
class Top:
    """The best scores so far, highest first, equal ones by id; at most k."""

    k: int
    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def empty(cls, k: int) -> Top:
        return cls(k, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))

    @property
    def kth(self) -> int:
        """What a score has to reach: nothing is known of the k-th before there are k."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores > 0) & (scores >= self.kth)
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def best_positions(block: Block, lists: np.ndarray, top: Top) -> int:
    """Add the block's best documents for the item with these lists to `top`; how many documents got a score.

    Documents that have no place in `top` may be left out once the bounds tell so.
    """
    begin, size = block.begin[lists], block.begin[lists + 1] - block.begin[lists]
    seen = [np.zeros(n, dtype=bool) for n in size]
    best = np.zeros(len(lists), dtype=np.int64)  # seen places without a gap, of each list
    scored = np.zeros(len(block.ids), dtype=bool)
    depth, step = 0, FIRST_READ
    while True:
        more = best < size
        bound = int(block.falling[(begin + best)[more]].sum())
        if bound == 0 or bound < top.kth:
            return int(scored.sum())
        read = [block.doc[b + depth: b + min(depth + step, n)] for b, n in zip(begin, size, strict=True)]
        docs = np.unique(np.concatenate(read))
        docs = docs[~scored[docs]]
        scored[docs] = True
        wanted = (lists[:, None] * len(block.ids) + docs).ravel()
        at = np.minimum(np.searchsorted(block.key, wanted), len(block.key) - 1)
        hit = (block.key[at] == wanted).reshape(len(lists), -1)
        at = at.reshape(hit.shape)
        top.add(np.where(hit, block.impact[at], 0).sum(axis=0), block.ids[docs])
        for i in range(len(lists)):
            seen[i][block.place[at[i][hit[i]]]] = True
            rest = seen[i][best[i]:]
            if len(rest):
                gap = int(rest.argmin())
                best[i] += len(rest) if rest[gap] else gap
        depth, step = depth + step, 2 * step


def _search(blocks: DataFrame, items: Items, k: int) -> DataFrame:
    """item_id, doc_id, score, part: the k best documents of each item in each task's blocks."""
    spark = blocks.sparkSession
    totals = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, total = int(totals[0] or 0), int(totals[1] or 0)
    held = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("e")).groupBy("e.terms").agg(F.sum("e.counts"))
    weight = np.zeros(len(items.numbers), dtype=np.int64)
    for term, df in held.collect():  # a row for each term of the batch at most
        weight[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    known = spark.sparkContext.broadcast((items.ids, items.first, items.terms, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, first, terms, weights = known.value
        tops: dict[int, Top] = {}
        local = np.full(len(weights), -1, dtype=np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].values.to_numpy() for c in ("doc_ids", "lengths", "terms", "counts", "holders", "times")}
                own, block = Block.of(row, weights, n, total)
                local[own] = np.arange(len(own))
                for i in range(len(ids)):
                    lists = local[terms[first[i]: first[i + 1]]]
                    if (lists := lists[lists >= 0]).size:
                        best_positions(block, lists, tops.setdefault(i, Top.empty(k)))
                local[own] = -1
        found = [(ids[i], top) for i, top in tops.items()]
        if found:
            size = [len(top.ids) for _, top in found]
            doc_ids = np.concatenate([top.ids for _, top in found])
            part = np.full(len(doc_ids), TaskContext.get().partitionId() % BUNCHES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([i for (i, _), m in zip(found, size, strict=True) for _ in range(m)], pa.int64()),
                pa.array(doc_ids, mask=doc_ids == NULL_ID),
                pa.array(np.concatenate([top.scores for _, top in found])), pa.array(part),
            ], ["item_id", "doc_id", "score", "part"])

    columns = ["doc_ids", "lengths", "terms", "counts", "holders", "times"]
    return blocks.select(columns).mapInArrow(run, "item_id long, doc_id long, score long, part int")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    bunch = F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    merged = found.withColumn("rank", bunch).where(F.col("rank") <= k).withColumn("rank", rank).where(F.col("rank") <= k)
    return merged.select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """item_id, rank, doc_id, score: of each item the k documents with the highest scores above 0; docs: doc_id, text; items: item_id, text.

    Equal scores go by doc_id, null ids last. Null and empty texts have no terms: such documents are
    counted nowhere, such items have no rows. Repeated rows of docs are documents of their own; rows of one
    item_id (null too) are one item. Texts of any length are indexed whole. No rows on either side: no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), text_of(F.col("text")).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, math.ceil(size / batch_bytes))
    found = []
    for b in range(batches):
        own = items_of([tuple(r) for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == b).collect()])
        vocabulary = spark.sparkContext.broadcast(own.numbers)
        blocks = stored(index(docs.select("doc_id", "text"), vocabulary, block_bytes), "blocks")
        ranked = _ranked(_search(blocks, own, k), k)
        found.append(ranked if batches == 1 else stored(ranked, "ranked"))
    return reduce(DataFrame.unionByName, found)
