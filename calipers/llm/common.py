"""Helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calipers.runtime import ensure_checkpoint_dir


def packed(docs: DataFrame) -> DataFrame:
    """All columns of `docs` inside one struct `row`, so that no name can clash with an operator's own."""
    return docs.select(F.struct("*").alias("row"))


def text_of(text: Column) -> Column:
    """A null text counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back.

    Cuts lineage like a checkpoint; the table keeps columns apart, so that later
    steps read only what they need, and every executor can reach it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """The same in `parts` buckets by `key`: joins on the key later need no exchange of this side.

    Row groups are kept small, so that rows of megabytes do not pile up in a writer or reader.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    label = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(parts, key).write.format("parquet").option("parquet.block.size", 8 << 20)
    writer.option("compression", "none").option("path", f"{folder}/{label}").bucketBy(parts, key).saveAsTable(label)
    return spark.table(label)


def by_size(batches: Iterator[pa.RecordBatch], most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most_bytes` of text each (a longer text stands alone)."""
    for batch in batches:
        ends = np.cumsum(np.append(0, pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + most_bytes, side="right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
