"""From raw documents to packed training sequences, in stages that can be run and stored one by one.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but
the last return the columns of documents. A null text, a repeated row or an empty table is
treated as the stage's operator says; no stage fails on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from switchboard.llm import bpe, near_dedup, packing, quality, suffix_dedup, toxicity
from switchboard.llm.frames import table
from switchboard.session import store

# Near duplicates: word shingles and percent of similarity. Repeats: bytes.
SHINGLE, SIMILAR = 5, 80
REPEAT = 256


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one(docs, SHINGLE, SIMILAR)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long repeated passages stay in their first place only."""
    return suffix_dedup.cut_repeats(docs, REPEAT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces with their places in sequences."""
    return packing.pack(docs, bpe.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

# Learned models and tokens are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
