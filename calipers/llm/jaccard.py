"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Every distinct shingle set is a node. Its signature is cut into trees; in each tree the
nodes are sorted by prefix, as in a trie. Nodes meet that share a prefix in a tree. The prefix is
shortened from the whole depth on, level by level, until pairs of the least similarity meet with the
target recall; this is measured on sets of the table and changed copies of them, of just that similarity, so
that no pair's chance depends on how many others are more alike. Pairs that meet are verified on the
shingle sets, each where it meets first.

A trie node may hold very many members. It is cut into blocks, and each pair of blocks is a
task of its own; tasks give back counts per member and a spanning forest, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import by_size, packed, stored, text_of
from calipers.llm.words import groups_of, mixed, shingles_of, words_of
from calipers.operators.components import component_labels
from calipers.runtime import checkpointed, ship

WIDTH, SIMILARITY = 5, 0.8
#: Trees, and minima in each one's whole prefix; of each minimum the lower 16 bits are kept.
TREES, DEPTH = 15, 6
#: Texts whose sets are changed to measure the recall of a level, copies of each, and shingles taken of each.
MEASURED, COPIES, TAKEN = 300, 40, 150
BLOCK = 512

_SALTS = mixed(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def text_key(text: Column) -> list[Column]:
    """A 96-bit key of the text, computed without Python."""
    whole = text_of(text)
    return [F.xxhash64(whole).alias("text_hash"), F.crc32(whole.cast("binary")).alias("text_crc")]


def shingle_sets(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, shingles with repeats, distinct sorted shingles) of every text with a word."""
    for begin, end in groups_of(texts):
        values, first = shingles_of(words_of(texts[begin:end]), WIDTH)
        for i in range(begin, end):
            own = values[first[i - begin]: first[i - begin + 1]]
            if len(own):
                yield i, own, np.unique(own)


def _signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of TREES * DEPTH minima, their lower 16 bits, for each text; every text has a shingle."""
    out = np.empty((len(first) - 1, len(_SALTS)), dtype=np.uint16)
    spread = values ^ (values >> np.uint64(29))
    ranks = np.empty_like(spread)
    for k, salt in enumerate(_SALTS):
        np.multiply(spread, salt, out=ranks)
        out[:, k] = (np.minimum.reduceat(ranks, first[:-1]) >> np.uint64(32)).astype(np.uint16)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text key, node (128-bit key of the shingle set, null without a word), signature."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, 1 << 18):
            values, first = shingles_of(words_of(part.column("text").to_pylist()), WIDTH)
            nodes: list = [None] * part.num_rows
            signs: list = [None] * part.num_rows
            filled = np.flatnonzero(np.diff(first))
            if len(filled):
                sets = [np.unique(values[first[i]: first[i + 1]]) for i in filled]
                bounds = np.cumsum([0, *(len(s) for s in sets)])
                joined = np.concatenate(sets)
                del values, sets
                rows = _signatures(joined, bounds)
                sums = np.stack([np.add.reduceat(mixed(joined + np.uint64(c)), bounds[:-1]) for c in (1, 2)], axis=1)
                for j, i in enumerate(filled):
                    nodes[i], signs[i] = sums[j].tobytes(), rows[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "text_hash", "text_crc")), pa.array(nodes, pa.binary()), pa.array(signs, pa.binary())],
                ["doc_id", "text_hash", "text_crc", "node", "signature"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text")), text_of(F.col("text")).alias("text")
    )
    return texts.mapInArrow(run, "doc_id long, text_hash long, text_crc long, node binary, signature binary")


def changed_pairs(sets: list[np.ndarray], copies: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets, `copies` times each, and of copies changed until their similarity is only just SIMILARITY."""
    rng = np.random.default_rng(seed)
    left, right = [], []
    for own in sets:
        n = len(own)
        common = math.ceil(2 * n * SIMILARITY / (1 + SIMILARITY) - 1e-9)
        for _ in range(copies):
            left.append(own)
            right.append(np.concatenate([rng.permutation(own)[:common], rng.integers(0, 2**63, n - common, dtype=np.uint64)]))
    bounds = np.cumsum([0, *map(len, left)])
    return _signatures(np.concatenate(left), bounds), _signatures(np.concatenate(right), bounds)


def measured_recalls(sets: list[np.ndarray]) -> list[float]:
    """For prefixes of 1 to DEPTH minima: which part of the changed pairs shares one in some tree."""
    left, right = changed_pairs(sets, COPIES)
    same = (left == right).reshape(len(left), TREES, DEPTH)
    return [float(same[:, :, :depth].all(axis=2).any(axis=1).mean()) for depth in range(1, DEPTH + 1)]


def shortened(recalls: list[float], target: float) -> int:
    """The prefix length at which to stop, going down from the whole depth until the recall reaches the target."""
    depth = len(recalls)
    while recalls[depth - 1] < target:
        depth -= 1
        if not depth:
            raise ValueError(f"{TREES} trees meet {recalls[0]} of the pairs at {SIMILARITY} at most, not {target}")
    return depth


def sampled_sets(docs: DataFrame) -> list[np.ndarray]:
    """Shingle sets of up to about MEASURED texts, chosen by a hash, TAKEN shingles of each; random sets where there are fewer."""
    usable = docs.select(F.col("text").cast("string").alias("text")).where("length(text) between 1000 and 50000")
    share, among = min(1.0, MEASURED / max(1, usable.count())), 1 << 40
    sample = usable.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(among)) < math.ceil(share * among))
    texts = sorted(r.text for r in sample.limit(2 * MEASURED).collect())
    rng = np.random.default_rng(7)
    sets = [rng.permutation(own)[:TAKEN] for _, _, own in shingle_sets(texts) if len(own) >= TAKEN][:MEASURED]
    return sets + [rng.integers(0, 2**63, TAKEN, dtype=np.uint64) for _ in range(MEASURED - len(sets))]


def _pairs(begin: np.ndarray, size: np.ndarray, left: np.ndarray, both: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, cell) row numbers of the pairs of cells, about a quarter million at a time.

    A cell's rows stand together. A cell of one block pairs all its rows; a cell of two
    blocks pairs the first `left` rows with the others.
    """
    single = np.flatnonzero(~both & (size > 1))
    for g in np.unique(size[single]):
        cells = single[size[single] == g]
        a, b = np.triu_indices(g, 1)
        together = max(1, 250_000 // len(a))
        for k in range(0, len(cells), together):
            part = cells[k: k + together]
            yield (begin[part][:, None] + a).ravel(), (begin[part][:, None] + b).ravel(), np.repeat(part, len(a))
    for cell in np.flatnonzero(both & (left > 0) & (left < size)):
        a, b = np.meshgrid(np.arange(left[cell]), np.arange(left[cell], size[cell]), indexing="ij")
        yield begin[cell] + a.ravel(), begin[cell] + b.ravel(), np.full(a.size, cell)


def _candidates(rows: pd.DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers i, j of the likely pairs that first meet in their cell, and their cell's number."""
    signs = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint16).reshape(len(rows), -1)
    tree = rows["tree"].to_numpy()
    number, begin = _cell_numbers(rows)
    size = np.diff(np.append(begin, len(rows)))
    lo, hi, block = rows["lo"].to_numpy(), rows["hi"].to_numpy(), rows["block"].to_numpy()
    left = np.bincount(number, block == lo, len(begin)).astype(np.int64)
    # Five standard errors below the threshold: a pair at 0.8 falls under it once in ten million.
    least = len(_SALTS) * SIMILARITY - 5 * np.sqrt(len(_SALTS) * SIMILARITY * (1 - SIMILARITY))
    found = [(np.zeros(0, np.int64),) * 3]
    for i, j, cell in _pairs(begin, size, left, (lo != hi)[begin]):
        equal = np.zeros(len(i), dtype=np.uint8)
        first = np.full(len(i), TREES, dtype=np.int8)
        for t in reversed(range(TREES)):
            prefix = np.ones(len(i), dtype=bool)
            for d in range(DEPTH):
                same = signs[i, t * DEPTH + d] == signs[j, t * DEPTH + d]
                equal += same
                if d < depth:
                    prefix &= same
            first[prefix] = t
        near = np.flatnonzero((equal >= least) & (first == tree[i]))
        found.append((i[near], j[near], cell[near]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _cell_numbers(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's cell, and the first row of each cell; rows of a cell stand together."""
    keys = [rows[c].to_numpy() for c in ("bucket", "tree", "lo", "hi")]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches of a partition that is sorted by cell, cut where a cell ends."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = int(_cell_numbers(batch)[1][-1]) if len(batch) else 0
        if last:
            yield batch.iloc[:last].reset_index(drop=True)
        rest = batch.iloc[last:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def _in_cells(cells: DataFrame) -> DataFrame:
    """Every cell in one partition, its first block first."""
    return cells.repartition("bucket", "tree", "lo", "hi").sortWithinPartitions(
        "bucket", "tree", "lo", "hi", F.col("block") != F.col("lo")
    )


def _cells(members: DataFrame) -> DataFrame:
    """bucket, tree, node of nodes in tries -> a row for each cell (pair of blocks of a bucket) the node is in."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    return members.join(sizes, "bucket").withColumns({"blocks": blocks}).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    ).select(
        "bucket", "tree", "node", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "bucket", "tree", "node", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    )


def _screen(nodes: DataFrame, depth: int) -> DataFrame:
    """Members that have a likely partner in a cell."""
    prefix = lambda t: F.substring("signature", t * DEPTH * 2 + 1, depth * 2)
    members = nodes.select("node", F.explode(F.array(*(
        F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), prefix(t)).alias("bucket")) for t in range(TREES)
    ))).alias("m")).select("m.bucket", "m.tree", "node")
    cells = _cells(members).join(nodes.select("node", "signature"), "node")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_cells(batches):
            i, j, _ = _candidates(rows, depth)
            used = np.unique(np.concatenate([i, j]))
            yield rows.iloc[used][["bucket", "tree", "node", "block", "lo", "hi", "signature"]]

    return _in_cells(cells).mapInPandas(
        run, "bucket long, tree int, node binary, block int, lo int, hi int, signature binary"
    )


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets i and j, for a few pairs one by one, else by products of 0/1 matrices."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[column]
    order = np.argsort(rank, kind="stable")
    rank, owner = rank[order], owner[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    for begin in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(rank, [begin, begin + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[a:b], rank[a:b] - begin] = 1
        common += part @ part.T
    return common[i, j].astype(np.int64)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row number in each row's component."""
    root = np.arange(n)
    while len(i):
        before = root.copy()
        low = np.minimum(root[i], root[j])
        for end in (i, j):
            np.minimum.at(root, end, low)
            np.minimum.at(root, root[end], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _verify(rows: pd.DataFrame, depth: int) -> pd.DataFrame:
    """Exact links in whole cells: per node the linked documents, and its root in a spanning forest of the cell."""
    i, j, cell = _candidates(rows, depth)
    order = np.argsort(cell, kind="stable")
    i, j, cell = i[order], j[order], cell[order]
    sets = [np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"]]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    both = np.zeros(len(i), dtype=np.int64)
    bounds = np.flatnonzero(np.append(np.diff(cell, prepend=-1) != 0, True))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own, place = np.unique(np.concatenate([i[a:b], j[a:b]]), return_inverse=True)
        both[a:b] = _common([sets[k] for k in own], place[: b - a], place[b - a:])
    linked = 5 * both >= 4 * (sizes[i] + sizes[j] - both)
    i, j = i[linked], j[linked]
    copies = rows["copies"].to_numpy()
    links = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
    root = _roots(len(rows), i, j)
    node = rows["node"].to_numpy()
    touched = np.unique(np.concatenate([i, j]))
    return pd.DataFrame({"node": node[touched], "links": links[touched].astype(np.int64), "root": node[root[touched]]})


def near_duplicates(docs: DataFrame, target: float = 0.999) -> DataFrame:
    """text key, label, class_id, links of every distinct text with a word; docs: doc_id, text.

    Two documents are linked when the Jaccard similarity of their sets of five-word
    shingles is at least 0.8; classes are connected by links; class_id is the least
    doc_id of a class (null ids count last, so it is null where all are).
    links counts the other documents linked to a document with that text, copies included.
    """
    seen = stored(sketches(docs), "sketches")
    nodes = seen.where("node is not null").groupBy("node").agg(
        F.first("signature").alias("signature"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"),
        F.min(F.struct("text_hash", "text_crc")).alias("key"),
    )
    nodes = stored(nodes, "nodes")
    depth = shortened(measured_recalls(sampled_sets(docs)), target)
    cells = stored(_screen(nodes.select("node", "signature"), depth), "forest")
    wanted = nodes.join(cells.select("node").distinct(), "node", "left_semi").select("node", "copies", "key.*")
    texts = docs.select(*text_key(F.col("text")), text_of(F.col("text")).alias("text"))
    texts = texts.join(wanted, ["text_hash", "text_crc"]).groupBy("node", "copies").agg(F.first("text").alias("text"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin, end in groups_of(batch["text"].tolist(), 4_000_000):
                part = batch.iloc[begin:end]
                found = {i: s.tobytes() for i, _, s in shingle_sets(part["text"].tolist())}
                out = part[["node", "copies"]].copy()
                out["shingles"] = [found[i] for i in range(len(part))]
                yield out

    filled = cells.join(texts.mapInPandas(sets, "node binary, copies long, shingles binary"), "node")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_cells(batches):
            yield _verify(rows, depth)

    checked = checkpointed(_in_cells(filled).mapInPandas(verify, "node binary, links long, root binary"))
    edges = checked.where("node <> root").select(F.lit(0).alias("g"), F.col("node").alias("a"), F.col("root").alias("b"))
    links = checked.groupBy("node").agg(F.sum("links").alias("others"))
    found = component_labels(edges, "g")
    labels = nodes.select("node", F.col("node").alias("label")) if found is None else nodes.select("node").join(
        found.select("node", "label"), "node", "left"
    ).select("node", F.coalesce("label", "node").alias("label"))
    known = nodes.select("node", "copies", "least").join(labels, "node").join(links, "node", "left")
    ids = known.groupBy("label").agg(F.min("least").alias("class_id"))
    of_node = known.join(ids, "label").select(
        "node", "label", "class_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    of_text = seen.where("node is not null").select("text_hash", "text_crc", "node").distinct()
    return stored(of_text.join(of_node, "node").drop("node"), "classes")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links of every row of docs.

    Null, empty and wordless texts are linked to nothing and are their own class.
    Texts of one to four words have one shingle, all their words. Repeated rows are
    linked to each other. No rows: no rows.
    """
    found = near_duplicates(docs.select("doc_id", "text"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text")))
    return keyed.join(found, ["text_hash", "text_crc"], "left").select(
        "doc_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, without the linked ones: the least doc_id of a class stays."""
    found = near_duplicates(docs.select("doc_id", "text"))
    keyed = packed(docs).select("row", *text_key(F.col("row.text"))).join(found, ["text_hash", "text_crc"], "left")
    first = keyed.where("label is not null").where(F.col("row.doc_id").cast("long").eqNullSafe(F.col("class_id")))
    lone = keyed.where("label is null").select("row")
    return first.dropDuplicates(["label"]).select("row").unionByName(lone).select("row.*")
