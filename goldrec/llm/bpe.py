"""Byte-level BPE: overlapping chunks, stitched where their pre-token boundaries agree.

A short text is one piece. A long one is cut into chunks that overlap; each chunk is pre-tokenised
by itself, wherever it happens to start. Two neighbours are stitched at the first boundary that
both found in their overlap: matches depend only on what follows them, so from a common boundary
on both agree. The text between two stitches is then encoded as a piece of its own.

Only boundaries after a non-blank count as stitches, since the pattern looks ahead after blanks.
Where an overlap holds no common boundary (one very long pre-token), the chunks from there on are
encoded as one piece, so the ids are exact in every case.

Null texts are empty, and empty texts give no ids. Repeated rows and ids each keep their row. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK, OVERLAP = 32_768, 1_024


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def _words(path: str) -> list[bytes]:
    ranks = _ranks(path)
    words = [b""] * (max(ranks.values()) + 1)
    for word, rank in ranks.items():
        words[rank] = word
    return words


def boundaries(text: str, at: int, pattern: str, ends: bool) -> list[int]:
    """Places after a pre-token that ends in a non-blank, as offsets in the whole text.

    The last pre-token of a cut text may go on behind the cut, so its end doesn't count.
    """
    found = [m.end() for m in regex.finditer(pattern, text)]
    return [at + x for x in (found if ends else found[:-1]) if not text[x - 1].isspace()]


def _encode_texts(texts: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ids (little-endian unsigned 32-bit) in place of the column text."""
    kept = [c for c in texts.columns if c != "text"]
    schema = texts.select(*kept, F.lit(0).cast("long").alias("n_tokens"), F.lit(b"").alias("ids")).schema

    def run(batches):
        encode = _encoding(path, pattern).encode_ordinary
        for batch in batches:
            ids = [np.asarray(encode(t), dtype="<u4") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=[*kept, "n_tokens", "ids"],
            )

    return texts.mapInArrow(run, schema)


def encode(documents: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) of every row's whole text."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long_ = F.length("text") > chunk
    short = _encode_texts(rows.where(~long_), ranks, pattern)

    key = ["doc_id", "digest", "length", "copies"]
    parts = (
        rows.where(long_)
        .groupBy("doc_id", "text").agg(F.count("*").alias("copies"))  # rows that repeat in full
        .select("doc_id", F.sha2("text", 256).alias("digest"), F.length("text").alias("length"), "copies", "text",
                F.explode(F.sequence(F.lit(0), F.length("text") - 1, F.lit(chunk))).alias("start"))
        .select(*key, "start", F.expr(f"substring(text, start + 1, {chunk + overlap})").alias("part"))
        .repartition(*key, "start")
    )
    found_schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in parts.schema)}, " \
        "head array<int>, tail array<int>"

    def find(batches):
        for batch in batches:
            heads, tails = [], []
            for start, length, part in zip(*(batch.column(c).to_pylist() for c in ("start", "length", "part"))):
                found = boundaries(part, start, pattern, start + len(part) >= length)
                heads.append([x for x in found if x < start + overlap])
                tails.append([x for x in found if x >= start + chunk])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "head", "tail"],
            )

    in_order = Window.partitionBy(*key).orderBy("start")
    stitched = (
        parts.mapInArrow(find, found_schema)
        .withColumn("common", F.array_min(F.array_intersect("head", F.lag("tail").over(in_order))))
        .withColumn("stitch", F.when(F.col("start") == 0, 0).otherwise(F.col("common")))
        # after a chunk without a stitch, later ones have nothing certain to agree with
        .withColumn("lost", F.max(F.col("stitch").isNull()).over(in_order))
        .withColumn("run", F.sum(F.when(F.col("lost"), 0).otherwise(1)).over(in_order))
    )
    pieces = (
        stitched.groupBy(*key, "run")
        .agg(F.min("start").alias("first"), F.min("stitch").alias("stitch"),
             F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
        .withColumn("until", F.coalesce(F.lead("stitch").over(Window.partitionBy(*key).orderBy("run")), "length"))
        .withColumn("body", F.array_join(F.transform("parts", lambda p, i: F.when(
            i < F.size("parts") - 1, F.substring(p["part"], 1, chunk)).otherwise(p["part"])), ""))
        .select(*key, "run", F.expr("substring(body, stitch - first + 1, until - stitch)").alias("text"))
    )
    whole = (
        _encode_texts(pieces, ranks, pattern)
        .groupBy(*key)
        .agg(F.sum("n_tokens").alias("n_tokens"),
             F.sort_array(F.collect_list(F.struct("run", F.hex("ids").alias("hex")))).alias("ids"))
        .select("doc_id", "n_tokens", F.unhex(F.array_join("ids.hex", "")).alias("ids"),
                F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        .drop("copy")
    )
    return short.unionByName(whole)


def decode(tokens: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for, one after another."""
    schema = tokens.withColumn(out, F.lit(b"")).schema

    def run(batches):
        word = _words(ranks).__getitem__
        for batch in batches:
            raw = [b"".join(map(word, np.frombuffer(x, "<u4").tolist())) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())],
                                             names=[*batch.schema.names, out])

    return tokens.mapInArrow(run, schema)


def token_digests(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens and the digests of its ids and of what they decode to."""
    return decode(encode(documents, ranks, pattern), ranks).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
