"""Corpus pipeline: each stage's result is written as Parquet and read again by the next.

Quality classifier, near-dedup, benchmark decontamination, mixing to target weights, token files.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, near_dups, quality, token_files
from tessera.llm.queries import TOKENIZER, read
from tessera.llm.scratch import Scratch
from tessera.session import ship_package


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship_package(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the smallest id stays."""
    ship_package(spark)
    return near_dups.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship_package(spark)
    return mixing.repeat_documents(docs, mixing.mix(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; a row for each document in them."""
    ship_package(spark)
    return token_files.encode_corpus(docs, TOKENIZER)


STAGES = [
    ("quality", keep_good),
    ("near_dups", drop_copies),
    ("decontaminate", drop_benchmark),
    ("mix", mix_sources),
    ("token_files", write_tokens),
]

# A language model, balanced sampling and a subword tokenizer have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
