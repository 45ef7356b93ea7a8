"""From raw documents to packed training sequences, as five stages over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from churnspark.llm import line_dedup, ngram_join, packing, quality_rules, suffix_dedup
from churnspark.llm.common import stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the current policy of quality rules keeps."""
    return quality_rules.keep_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that an earlier line nearly equals."""
    return line_dedup.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares most of its 5-word shingles."""
    return ngram_join.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 200 bytes or more that occur elsewhere too."""
    return suffix_dedup.drop_repeats(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2,048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeats),
    ("best_fit_packing", sequences),
]

#: Near-duplicates, byte passages, tokens and packing are beyond SQL; tests compare the stages
#: with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each one's rows are written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
