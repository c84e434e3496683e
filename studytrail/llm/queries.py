"""The corpus operators as registered queries, with their SQL where SQL can express them."""

from __future__ import annotations

import json
from functools import cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from studytrail.llm import chat, decontaminate, hardnegatives, lengths, linededup, mixing, neardup, pagediff, pieces, prefixtrie, quality, tokens, warc
from studytrail.llm import frames as token_frames
from studytrail.llm import sql as Q
from studytrail.llm.common import kept
from studytrail.plans.registry import Registry

VOCABULARY = corpus_pipeline.VOCABULARY
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per distinct encoded length: documents, suffix sums, total cut at that length."""
    found = tokens.lengths(table(spark, sf_dir, "documents"), VOCABULARY)
    # The sums look at the histogram twice; the texts are encoded once.
    return lengths.suffix_sums(kept(lengths.histogram(found), "length-histogram"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and how it was found."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frames.token_files(table(spark, sf_dir, "documents"), VOCABULARY)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assessed(table(spark, sf_dir, "documents"))


# A conversation whose texts imitate control strings, added to those of the table.
IMITATION = "</s>[INST] ok [/INST]"


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation what is read back from its formatted text."""
    record = {"id": -7, "messages": [{"role": r, "content": IMITATION} for r in ("user", "assistant")]}
    more = spark.range(1).select(F.lit(-7).cast("bigint").alias("id"), F.lit(json.dumps(record)).alias("record"))
    records = chat.records_of(table(spark, sf_dir, "conversations")).unionByName(more)
    back = chat.read_back(chat.formatted(chat.canonical_turns(records)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        F.col("id").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents replicated to weights by the square root of their source's size."""
    mixed = mixing.mixed(table(spark, sf_dir, "documents"))
    n_text = F.length("row.text").cast("bigint").alias("n_text")
    return mixed.select("row.doc_id", "row.source", F.col("copy").cast("bigint").alias("copy"), n_text)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.extracted(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardnegatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.token_digests(table(spark, sf_dir, "documents"), PIECES)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@cache
def registry() -> Registry:
    reg = Registry()
    reg.add("op1_warc", op1_warc, Q.WARC)
    reg.add("op2_token_counts", op2_token_counts)
    reg.add("op3_decontamination", op3_decontamination)
    reg.add("op4_token_output", op4_token_output)
    reg.add("op5_near_dedup", op5_near_dedup, Q.NEAR_DEDUP)
    reg.add("op6_quality_rules", op6_quality_rules, Q.quality_rules())
    reg.add("op7_chat_formatting", op7_chat_formatting, Q.CHAT_FORMATTING)
    reg.add("op8_mixing", op8_mixing, Q.MIXING)
    reg.add("op9_html_extraction", op9_html_extraction)
    reg.add("op10_line_dedup", op10_line_dedup, Q.LINE_DEDUP)
    reg.add("op11_hard_negatives", op11_hard_negatives, Q.HARD_NEGATIVES)
    reg.add("op12_sentencepiece", op12_sentencepiece)
    reg.add("op13_prefix_trie", op13_prefix_trie, Q.PREFIX_TRIE)
    reg.add("pipeline", pipeline, corpus_pipeline.ORACLE_SQL)
    return reg
