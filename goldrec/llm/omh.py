"""Order MinHash fingerprints.

A text's k-mers of code points are numbered by occurrence, so repeats count, and each numbered
k-mer is hashed once. The hash deals it to one of ``bins`` bins; of each bin the ``take`` smallest
are selected, put back into the order of the text, and hashed as a tuple. Two texts agree in a bin
if the same k-mers were selected and stand in the same order, which makes the likeness follow the
edit distance and not only the sets of k-mers. One hash with bins stands for as many permutations.

A text shorter than k is one k-mer, an empty one has none. A bin that has no k-mer is blank;
likeness is the share of equal bins among those that aren't blank in both, 1 for two empty texts.

Null texts are empty. Rows without an id come after all others, rows with one id in the order of their
texts; repeated rows each keep their row and are one another's next. A very long text is hashed whole, in
memory of some dozens of bytes a character. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import LOWEST, first_at_least

K, BITS, TAKE = 8, 6, 2
BLANK = "." * 8
#: Rows of a bucket of neighbouring ids, and the most buckets there are.
BUCKET_ROWS, MAX_BUCKETS = 1_000, 1_024
U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def kmer_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """A hash of each run of k code points; of all of them where there are fewer."""
    h = _mix(points.astype(U) + U(1))
    size = min(k, len(points))
    whole, span = None, 1
    # binary composition: runs of 1, 2, 4, ... joined to the wanted length
    need, done = size, 0
    while need:
        if need & 1:
            part = h[done:]
            whole = part if whole is None else whole[: len(part)] * U(0x9E3779B97F4A7C15 | 1) + part[: len(whole)]
            done += span
        need >>= 1
        if need:
            h = h[:-span] * U((0xD6E8FEB86659FD93 + 2 * span) | 1) + h[span:]
            span *= 2
    n = len(points) - size + 1
    return _mix(whole[:n])


def signature(text: str, k: int = K, bits: int = BITS, take: int = TAKE) -> str:
    """The fingerprint: 8 hexadecimal digits for each of 2**bits bins, or dots for a blank one."""
    bins = 1 << bits
    if not text:
        return BLANK * bins
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    h = kmer_hashes(points, k)
    n = len(h)
    at = np.argsort(h, kind="stable")  # by k-mer, then by place; all bits of the hash, so that texts of any length compare
    kmer = h[at]
    fresh = np.empty(n, bool)
    fresh[0] = True
    np.not_equal(kmer[1:], kmer[:-1], out=fresh[1:])
    index = np.arange(n)
    nth = index - np.maximum.accumulate(np.where(fresh, index, 0))
    value = _mix(kmer * U(0x9E3779B97F4A7C15) + nth.astype(U) * U(0xC2B2AE3D27D4EB4F))

    cut = 8.0 * take * bins / n  # enough small ones for every bin, as a rule
    while True:
        if cut < 1:
            few = np.flatnonzero((value << U(bits)) < U(int(cut * 2**63)) * U(2))
        else:
            few = np.arange(n)
        few = few[np.lexsort((at[few], value[few]))]
        box = (value[few] >> U(64 - bits)).astype(np.int64)
        starts = np.searchsorted(box, np.arange(bins + 1))
        if cut >= 1 or (np.diff(starts) >= take).all():
            break
        cut *= 8
    digest = np.zeros(bins, U)
    place = starts[:-1, None] + np.arange(take)
    there = place < starts[1:, None]
    chosen = few[np.minimum(place, max(0, len(few) - 1))]
    where = np.where(there, at[chosen], U(2**64 - 1))
    name = np.where(there, value[chosen], U(0))
    name = np.take_along_axis(name, np.argsort(where, axis=1, kind="stable"), axis=1)
    for i in range(take):
        digest = _mix(digest * U(0xFF51AFD7ED558CCD) + name[:, i] + U(1))
    hexes = (digest >> U(32)).astype(">u4").tobytes().hex()
    blank = np.flatnonzero(~there[:, 0])
    if len(blank) == 0:
        return hexes
    parts = [hexes[8 * i:8 * i + 8] for i in range(bins)]
    for i in blank:
        parts[i] = BLANK
    return "".join(parts)


def likeness(one: str, other: str) -> float:
    a, b = (np.frombuffer(x.encode(), "S8") for x in (one, other))
    used = (a != BLANK.encode()) | (b != BLANK.encode())
    n = int(used.sum())
    return 1.0 if n == 0 else float(((a == b) & used).sum() / n)


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row's whole text (null: empty)."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = rows.select("doc_id", F.lit("").alias("fingerprint")).schema

    def run(batches):
        for batch in batches:
            made = [signature(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(run, schema)


def in_descending_order(documents: DataFrame) -> DataFrame:
    """bucket, guest, doc_id, text: neighbours by descending doc_id share a bucket, in that order.

    The row that follows a bucket's last one is there too, as its guest. Ids are cut into buckets
    at their quantiles; there are at most MAX_BUCKETS of them, so what reaches the driver is
    bounded, and a bucket is only ever read in order, row by row. Null ids come last, rows with
    the same id are ordered by text.
    """
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("key"), "doc_id",
                            F.coalesce("text", F.lit("")).alias("text"))
    n = min(MAX_BUCKETS, -(-rows.count() // BUCKET_ROWS))
    probs = [i / n for i in range(1, n)]
    bounds = sorted(set(rows.approxQuantile("key", probs, 0.2 / n))) if probs else []
    bucket = first_at_least(-F.col("key"), sorted(-int(b) for b in bounds)) if bounds else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    firsts = rows.groupBy("bucket").agg(F.max("key").alias("key")).orderBy("bucket").collect()  # at most MAX_BUCKETS
    before = {firsts[i]["key"]: firsts[i - 1]["bucket"] for i in range(len(firsts))}
    homes = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.lit(None).cast("map<bigint,int>")
    return (
        rows.withColumn("host", F.try_element_at(homes, F.col("key")))
        .select("key", "doc_id", "text", F.explode(F.array(
            F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest")),
            F.struct(F.col("host").alias("bucket"), F.lit(1).alias("guest")))).alias("to"))
        .select("key", "doc_id", "text", "to.bucket", "to.guest")
        .where("bucket is not null")
        .repartition(max(1, n), "bucket")
        .sortWithinPartitions("bucket", "guest", F.desc("key"), "text")
    )


def edit_likeness(documents: DataFrame) -> DataFrame:
    """Each row against its edited text and against the next document by descending id.

    The edited text has its last third replaced by as much of the next document's beginning. The
    next of the last document is the first. One that is alone is its own next.
    """
    rows = in_descending_order(documents)
    kind = documents.schema["doc_id"].dataType
    schema = (f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def run(batches):
        kept = None  # (bucket, doc_id, text, fingerprint)
        out: list[tuple] = []
        arrow = None
        for batch in batches:
            for bucket, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text"))):
                made = None
                if kept and kept[0] == bucket:
                    own, mine = kept[2], kept[3]
                    cut = len(own) // 3
                    edited = own[:len(own) - cut] + text[:cut]
                    made = mine if text == own else signature(text)
                    changed = mine if edited == own else signature(edited)
                    out.append((kept[1], len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mine, changed,
                                likeness(mine, changed), likeness(mine, made)))
                # copies of one first key may be guests; only the first of them follows
                kept = None if guest else (bucket, doc_id, text, made or signature(text))
            if len(out) >= 256:
                yield _edit_batch(out, batch.column("doc_id").type)
                out = []
            arrow = batch.column("doc_id").type
        if out:
            yield _edit_batch(out, arrow)

    return rows.select("bucket", "guest", "doc_id", "text").mapInArrow(run, schema)


def _edit_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)
