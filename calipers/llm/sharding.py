"""Sharding by jump consistent hashing.

A document's shard follows from its id and the number of shards alone; no table of
ring positions is kept. With one more shard, one document in (shards + 1) moves, and
it moves into the new shard.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from calipers.llm.common import packed
from calipers.runtime import ship

#: Multiplier of the generator in the published jump hash (a fixed value).
JUMP_MULTIPLIER = 2862933555777941757
#: At most so many slices of the id range are counted apart; slices get longer beyond it.
MOST_PIECES = 4096

_PLACE = StructType([
    StructField("shard", IntegerType()), StructField("grown", IntegerType()), StructField("piece", LongType()),
])


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every unsigned 64-bit key: all keys jump on until they would leave the range."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), dtype=np.int64)
    ahead = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        at[live] = ahead[live]
        state[live] = state[live] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        stride = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[live] = ((at[live] + 1) * stride).astype(np.int64)
        live = live[ahead[live] < shards]
    return at


def place(docs: DataFrame, shards: int = 8, rows_per_piece: int = 100_000) -> DataFrame:
    """`row` (all columns of docs), size, text_crc32, shard, slot, grown_shard for every document.

    Slots count from 0 in each shard without gaps, in the order of doc_id (null first),
    then checksum and size. The id range is cut into slices; one pass counts the rows of
    each shard and slice, the running sums of this small table are the first slots of
    the slices, and rows are numbered inside a slice only.

    Null doc_id: treated as the key -1. Null text: no bytes, checksum 0. Repeated rows
    go to one shard and take a slot each, in any order among equals. No rows: no rows.
    """
    ship(docs.sparkSession)
    keyed = packed(docs).withColumn("key", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(-1)))
    rows = docs.count()
    pieces = min(MOST_PIECES, max(1, math.ceil(rows / rows_per_piece)))
    bounds = np.array([], dtype=np.int64)
    if pieces > 1:
        cuts = [i / pieces for i in range(1, pieces)]
        bounds = np.unique(np.array(keyed.approxQuantile("key", cuts, 0.1 / pieces), dtype=np.int64))

    @F.pandas_udf(_PLACE)
    def placed(key: pd.Series) -> pd.DataFrame:
        ids = key.to_numpy(dtype=np.int64)
        return pd.DataFrame({
            "shard": jump_hash(ids.view(np.uint64), shards).astype(np.int32),
            "grown": jump_hash(ids.view(np.uint64), shards + 1).astype(np.int32),
            "piece": np.searchsorted(bounds, ids, side="right").astype(np.int64),
        })

    at = keyed.withColumn("at", placed("key")).select("row", "key", "at.*")
    counts = at.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("rows"))
    first = counts.select(
        "shard", "piece",
        (F.sum("rows").over(Window.partitionBy("shard").orderBy("piece")) - F.col("rows")).alias("first"),
    )
    sized = at.withColumns({
        "size": (F.coalesce(F.octet_length(F.col("row.text").cast("string")), F.lit(0)) + 1).cast("long"),
        "text_crc32": F.coalesce(F.crc32(F.col("row.text").cast("string").cast("binary")), F.lit(0)).cast("long"),
    })
    order = Window.partitionBy("shard", "piece").orderBy(F.col("row.doc_id").asc_nulls_first(), "text_crc32", "size")
    return sized.join(first, ["shard", "piece"]).select(
        "row", "size", "text_crc32", "shard",
        (F.col("first") + F.row_number().over(order) - 1).cast("long").alias("slot"),
        F.col("grown").alias("grown_shard"),
    )


def shard_rows(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The digest of `place`, one row per document, without the texts."""
    return place(docs.select("doc_id", "text"), shards).select(
        F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        "grown_shard",
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The columns of docs, then shard and slot; where docs has columns of these names, under the next free ones."""
    taken, free = {name.lower() for name in docs.columns}, {}
    for name in ("shard", "slot"):
        tries = itertools.chain([name, f"{name}_of_{shards}"], (f"{name}_of_{shards}_{i}" for i in itertools.count(2)))
        free[name] = next(t for t in tries if t not in taken)
    placed = place(docs, shards)
    return placed.select("row.*", *(F.col(name).alias(alias) for name, alias in free.items()))
