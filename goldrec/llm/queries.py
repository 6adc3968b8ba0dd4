"""The corpus operators as queries over the test tables, with production parameters."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from goldrec.llm import (
    alignment, bpe, jaccard, language, licences, mixing, ngrams, omh, sharding, suffix, topk, toxicity, trie,
)
from goldrec.llm.common import prepare, table
from goldrec.llm.oracles import ORACLES  # noqa: F401


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf_dir, "documents")


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return topk.nearest(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.quality_report(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_report(documents(spark, sf_dir))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.edit_likeness(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(documents(spark, sf_dir), BYTE_LEVEL, PIECES, public_tokenizers.PATTERN)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_top_k, op3_quality, op4_jaccard_join, op5_suffix_dedup, op6_bpe, op7_sharding, op8_mixing, op9_licences, op10_order_minhash,
    op11_prefix_trie, op12_alignment, op13_toxicity)}
