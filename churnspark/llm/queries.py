"""The operators as queries over the whole given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from churnspark.llm import (
    bpe_codec, embedding_dedup, line_dedup, merkle, ngram_join, packing, quality_classifier,
    quality_rules, sharding, spelling, suffix_dedup, token_counts, token_orc)
from churnspark.llm.common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_array_dedup(spark, sf):
    return suffix_dedup.digests(suffix_dedup.cut_repeats(table(spark, sf, "documents")))


@query
def op2_quality_rules(spark, sf):
    entries = quality_rules.write_ledger(table(spark, sf, "documents"))
    return quality_rules.apply_policy(entries, quality_rules.POLICIES[quality_rules.CURRENT]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
        "base_failed", "kept")


ORACLE_SQL["op2_quality_rules"] = quality_rules.ORACLE


@query
def quality_rule_ablation(spark, sf):
    """What each rule of op2's current policy costs, from the stored ledger."""
    entries = quality_rules.write_ledger(table(spark, sf, "documents"))
    return quality_rules.ablation(entries, quality_rules.POLICIES[quality_rules.CURRENT])


ORACLE_SQL["quality_rule_ablation"] = quality_rules.ABLATION_ORACLE


@query
def op3_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), WORD_BPE)


@query
def op4_line_dedup(spark, sf):
    return line_dedup.line_report(table(spark, sf, "documents"))


@query
def op5_embedding_dedup(spark, sf):
    return embedding_dedup.near_duplicates(table(spark, sf, "embeddings"))


@query
def op6_bpe_codec(spark, sf):
    docs = table(spark, sf, "documents")
    tokens = bpe_codec.encode(docs, RANKS, public_tokenizers.PATTERN)
    return bpe_codec.digests(bpe_codec.decode(tokens, RANKS, public_tokenizers.PATTERN))


@query
def op7_token_orc(spark, sf):
    path = scratch(spark, "tokens-orc")
    token_orc.write_tokens(table(spark, sf, "documents"), path, BYTE_BPE)
    return token_orc.digests(spark, path)


@query
def op8_ngram_join(spark, sf):
    return ngram_join.groups(table(spark, sf, "documents"))


@query
def op9_quality_classifier(spark, sf):
    return quality_classifier.resample(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"), BYTE_BPE)


@query
def op11_histogram_sharding(spark, sf):
    docs, path = table(spark, sf, "documents"), scratch(spark, "shards")
    sharding.write_shards(docs, path)
    return sharding.digests(spark, path, docs.schema)


ORACLE_SQL["op11_histogram_sharding"] = sharding.ORACLE


@query
def op12_spelling_variants(spark, sf):
    return spelling.variants(table(spark, sf, "documents"))


ORACLE_SQL["op12_spelling_variants"] = spelling.ORACLE


@query
def op13_merkle_manifest(spark, sf):
    return merkle.report(merkle.build(table(spark, sf, "documents")))


ORACLE_SQL["op13_merkle_manifest"] = merkle.ORACLE
