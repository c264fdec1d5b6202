"""A training corpus from `documents`: each stage is one corpus operator, applied to all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotwise.llm import exact_dedup, language_id, minhash, mixing, piece_bpe
from slotwise.llm.common import new_stage, table


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language of the model go."""
    return language_id.keep_languages(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row with the largest id stays."""
    return exact_dedup.exact_dedup(docs, single=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8), the document with the smallest id stays."""
    return minhash.near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the last one of a source is cut at its budget."""
    return mixing.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the hash of the text they decode to."""
    return piece_bpe.encode_and_check(docs, piece_bpe.default_vocabulary())


STAGES = [("language_id", languages), ("exact_dedup", exact), ("minhash", near), ("mixing", mix), ("sentencepiece", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(path := new_stage(spark, f"pipeline-{name}"))
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language and near copies can't be had in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None
