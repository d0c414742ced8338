"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Rotations that make the signs of centred vectors keep their distances (iterative
quantisation) are learnt on a bounded sample. Codes are cut into bytes; each byte position
has a table from value to rows. A code within Hamming distance r of the query's agrees with
it up to r // bytes bits in one position at least (pigeonhole), so probing all table entries
that near finds every code within r. Those are ranked by the float vectors.

Queries and rows meet in blocks: a task has a block of rows and a block of queries and gives
back a short list per query, so nothing grows with both.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calipers.runtime import ship

BITS = 128
#: Rows that the codes are learnt from, at most about.
SAMPLE = 8_192
ROW_BLOCK, LEAST_ROW_BLOCKS, QUERY_BLOCK = 65_536, 16, 4_096

_BYTE_DISTANCE = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


@dataclass
class Coder:
    mean: np.ndarray
    planes: np.ndarray  # (dimensions, bits)
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of bytes per vector."""
        return np.packbits((vectors - self.mean) @ self.planes > 0, axis=1)


def distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - query) ** 2).sum(axis=1))


def _rotation(centred: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    d = centred.shape[1]
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    for _ in range(rounds):
        signs = np.where(centred @ turn > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(centred.T @ signs)
        turn = u @ v
    return turn


def learn(sample: np.ndarray, k: int, target: float = 0.98, probes: int = 256) -> Coder:
    """Rotations, and the least radius at which the sample's own nearest neighbours are found with the target recall.

    In the whole table neighbours are nearer than in a sample of it, so the recall there is not lower.
    """
    mean = sample.mean(axis=0)
    d = sample.shape[1]
    turns = [_rotation(sample - mean, seed) for seed in range(math.ceil(BITS / d))]
    coder = Coder(mean, np.concatenate(turns, axis=1)[:, :BITS], BITS)
    codes = coder.codes(sample)
    needed: list[np.ndarray] = []
    for i in range(min(probes, len(sample))):
        order = np.argsort(distances(sample[i], sample), kind="stable")
        near = order[order != i][:k]
        needed.append(np.bitwise_count(codes[near] ^ codes[i]).sum(axis=1))
    found = np.sort(np.concatenate(needed)) if needed else np.zeros(0)
    if len(found):
        coder.radius = int(found[min(len(found) - 1, math.ceil(target * len(found)) - 1)])
    return coder


class Tables:
    """For each byte position the rows in the order of their values, and where each value begins."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.bounds = np.stack([
            np.searchsorted(codes[self.order[:, p], p], np.arange(257)) for p in range(codes.shape[1])
        ])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius, by probing every table."""
        near = np.zeros(len(self.codes), dtype=bool)
        for p in range(self.codes.shape[1]):
            for value in np.flatnonzero(_BYTE_DISTANCE[code[p]] <= radius // self.codes.shape[1]):
                near[self.order[self.bounds[p, value]: self.bounds[p, value + 1], p]] = True
        rows = np.flatnonzero(near)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= radius]


def nearest(coder: Coder, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, distances) of the k nearest rows found; the radius grows where fewer are found."""
    tables = Tables(coder.codes(vectors))
    for number, code in enumerate(coder.codes(queries)):
        radius = coder.radius
        rows = tables.within(code, radius)
        while len(rows) < min(k, len(ids)):
            radius = min(BITS, radius + 8)
            rows = tables.within(code, radius)
        far = distances(queries[number], vectors[rows])
        best = np.lexsort((ids[rows], far))[:k]
        yield number, ids[rows][best], far[best]


def usable(vector: Column) -> Column:
    """Not null, not empty, without null or non-finite components, not zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, its own row left out.

    vectors and queries: vec_id, embedding (array of numbers). Nearness is Euclidean distance
    in double precision, ties go to the smaller vec_id. Only vectors of the query's length
    are compared. Rows without vec_id, and vectors that are null, empty, zero or hold null
    or non-finite components take no part. Repeated rows are candidates each; of the rows
    with the query's own vec_id the nearest is taken as its own. No usable rows: no rows.
    """
    ship(vectors.sparkSession)
    plain = lambda df: df.select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    ).where(F.col("id").isNotNull()).where(usable(F.col("v"))).withColumn("d", F.size("v"))
    rows, asked = plain(vectors), plain(queries).distinct()
    sizes = {r.d: r.n for r in rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}
    coders: dict[int, Coder] = {}
    for d, n in sizes.items():
        share = min(1.0, SAMPLE / n)
        sample = rows.where((F.col("d") == d) & (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)))
        coders[d] = learn(np.array([r.v for r in sample.orderBy("id").select("v").collect()]), k)
    row_blocks = max(LEAST_ROW_BLOCKS, math.ceil(sum(sizes.values()) / ROW_BLOCK))
    query_blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = rows.withColumn("rb", F.pmod(F.xxhash64("id"), F.lit(row_blocks))).withColumn("qb", every(query_blocks))
    right = asked.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(query_blocks))).withColumn("rb", every(row_blocks))

    def meet(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(queries):
            data, points = np.stack(own["v"].to_numpy()), np.stack(queries["v"].to_numpy())
            names, ids = queries["id"].to_numpy(), own["id"].to_numpy()
            for number, found, far in nearest(coders[data.shape[1]], ids, data, points, k + 1):
                out += [(names[number], points[number], i, s) for i, s in zip(found, far, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "v", "vec_id", "score"])

    short = left.groupBy("d", "rb", "qb").cogroup(right.groupBy("d", "rb", "qb")).applyInPandas(
        meet, "query_id long, v array<double>, vec_id long, score double"
    )
    same = F.col("query_id") == F.col("vec_id")
    own_first = Window.partitionBy("query_id", "v").orderBy(F.when(same, 0).otherwise(1), "score")
    by_rank = Window.partitionBy("query_id", "v").orderBy("score", "vec_id")
    others = short.withColumn("own", same & (F.row_number().over(own_first) == 1)).where("not own")
    return others.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def search_hundredths(vectors: DataFrame, k: int = 10) -> DataFrame:
    """The rows whose vec_id is divisible by 100 as queries against all rows."""
    rows = vectors.select("vec_id", "embedding")
    return search(rows, rows.where(F.col("vec_id") % 100 == 0), k)
