"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from switchboard.llm import (
    bpe,
    fill_middle,
    fingerprints,
    kd_shards,
    near_dedup,
    packing,
    pieces,
    prefix_trie,
    quality,
    span_dedup,
    suffix_dedup,
    topk,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": fingerprints.op1,
        "op2_suffix_dedup": suffix_dedup.op2,
        "op3_topk": topk.op3,
        "op4_quality": quality.op4,
        "op5_bpe": bpe.op5,
        "op6_kd_shards": kd_shards.op6,
        "op7_span_dedup": span_dedup.op7,
        "op8_near_dedup": near_dedup.op8,
        "op9_packing": packing.op9,
        "op10_toxicity": toxicity.op10,
        "op11_prefix_trie": prefix_trie.op11,
        "op12_pieces": pieces.op12,
        "op13_fill_middle": fill_middle.op13,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_topk": topk.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE, "op13_fill_middle": fill_middle.ORACLE}
