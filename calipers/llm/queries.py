"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from calipers.llm import decontaminate, html, jaccard, licences, mixing, neighbours, packing, ranking, repeats, runs, secrets, sharding, toxicity
from calipers.llm.common import table
from calipers.llm.sql import MIX, RANK, SHARD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cgk_leaks": lambda spark, sf: decontaminate.leaks(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    ),
    "op2_jump_shards": lambda spark, sf: sharding.shard_rows(table(spark, sf, "documents")),
    "op4_jaccard_forest": lambda spark, sf: jaccard.classes(table(spark, sf, "documents")),
    "op5_guess_secrets": lambda spark, sf: secrets.scan(table(spark, sf, "documents")),
    "op6_multi_index": lambda spark, sf: neighbours.search_hundredths(table(spark, sf, "embeddings")),
    "op7_lpf_repeats": lambda spark, sf: repeats.trimmed(table(spark, sf, "documents")),
    "op8_licence_digests": lambda spark, sf: licences.scan(table(spark, sf, "documents")),
    "op9_toxic_grammar": lambda spark, sf: toxicity.score_rows(
        table(spark, sf, "documents"), table(spark, sf, "labels")
    ),
    "op3_curriculum_mix": lambda spark, sf: mixing.mix_rows(table(spark, sf, "documents")),
    "op10_crf_pages": lambda spark, sf: html.extract_rows(table(spark, sf, "pages")),
    "op11_best_position": lambda spark, sf: ranking.search(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    ),
    "op12_minimizer_runs": lambda spark, sf: runs.run_rows(table(spark, sf, "documents")),
    "op13_squares_packing": lambda spark, sf: packing.pack(
        table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json")
    ),
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {"op2_jump_shards": SHARD, "op3_curriculum_mix": MIX, "op11_best_position": RANK}
