"""Documents to tokens: quality, near duplicates, repeated passages, mixing, encoding.

Every stage takes documents with nulls anywhere, empty and very long texts, repeated rows, no rows at all and
further columns, and hands these columns on; what each gives then is said in its operator's module. Rows
without text go in the first stage; rows without id stay, one by one, until the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from goldrec.llm import bpe, jaccard, mixing, ngrams, suffix
from goldrec.llm.common import prepare, table, written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above their language's threshold go."""
    prepare(spark)
    return ngrams.judge(docs, table(spark, sf_dir, "labels")).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays; rows without id stay."""
    prepare(spark)
    groups = jaccard.near_duplicates(docs.where("doc_id is not null"))
    first = written(groups.where("doc_id = component_id").select("doc_id").distinct(), "kept")
    stay = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return stay.unionByName(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that also start earlier go; what is left is the text."""
    prepare(spark)
    return suffix.deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often, and as far, as the mix takes it."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to."""
    prepare(spark)
    return bpe.token_digests(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", tokens),
]

#: SQL can express neither the model nor the removal of repeated bytes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
