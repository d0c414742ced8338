"""From raw documents to sharded training rows: five stages, each a table that the next one reads.

Each stage takes (spark, docs, sf_dir); docs has the columns of documents, in any order and
with any more, and all stages but the last keep them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from calipers.llm import decontaminate, jaccard, mixing, sharding, toxicity
from calipers.llm.common import stored, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar calls toxic go; it learns from the labelled rows of the raw documents."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of five-word shingles, the one with the least id stays."""
    return jaccard.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, give or take a fifth of its words, go."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order."""
    return mixing.training_order(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", toxic), ("near_duplicates", near_copies), ("decontamination", benchmark_leaks), ("mixing", mixed),
    ("sharding", sharded),
]

#: The grammar's weights and the forest's classes have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
