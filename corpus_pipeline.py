"""From raw documents to token files: quality, near duplicates, benchmark leaks, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage
keeps as Parquet and hands the table to the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from studytrail.llm import decontaminate, frames, mixing, neardup, quality
from studytrail.llm.common import kept

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' weighed votes accept."""
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them, verbatim or with other numbers and names."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources weigh as the square root of their size."""
    return mixing.mixed(docs).select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document written."""
    return frames.token_files(docs, VOCABULARY)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token output", token_output),
]

# The tokenizer has no counterpart in SQL; the tests hold run() against a plain replay.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
