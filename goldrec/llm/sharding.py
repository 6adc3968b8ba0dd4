"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual`` points of a ring of 64-bit hashes. A row belongs to the first point
at or after the hash of its id. A shard takes no more rows than its capacity; what overflows goes
on clockwise to the next shard with room. Without slack the capacities differ by one row at most
and add up to all rows, so the counts do too (the law ``rows``); with slack fewer rows move when
shards are added.

Only counts decide where an arc of the ring overflows. They are one number per virtual node, so
the walk runs on ``shards * virtual`` counts whatever the size of the table. Rows are then ranked
within their arc, and a rank range of an arc is one shard's. An arc is cut into slices of about
``SLICE_ROWS`` rows by a hash of the rows' content, and a rank is the rows of the slices before plus the place in
the slice; rows that repeat in full are counted into one and written out again in blocks. So one id, or no
id, on a third of all rows is spread like any other.

Null texts have size 16 and the checksum 0; a null id has the hash of no value. Rows that repeat
are placed one by one. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldrec.llm.common import first_at_least, literal_rows

SHARDS, VIRTUAL, SLICE_ROWS = 40, 100, 100_000


def ring(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(point, shard) clockwise. Points depend on the shard and the virtual node alone."""
    points = {}
    for shard in range(shards):
        for node in range(virtual):
            digest = hashlib.sha256(f"{shard}:{node}".encode()).digest()
            points.setdefault(int.from_bytes(digest[:8], "big", signed=True), shard)
    return sorted(points.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    even, more = divmod(rows, shards)
    exact = [even + (shard < more) for shard in range(shards)]
    return exact if slack == 0 else [max(x, int(-(-rows * (1 + slack) // shards))) for x in exact]


def walk(owners: list[int], counts: list[int], room: list[int]) -> list[dict]:
    """Rank ranges of each arc with their shard and their first slot in it.

    Rows first fill the shard they belong to, arc by arc; the overflow then goes clockwise.
    """
    room, used, arcs = list(room), [0] * len(room), len(owners)
    ranges: list[dict] = []

    def put(arc: int, begin: int, n: int, shard: int) -> None:
        if n:
            ranges.append({"arc": arc, "begin": begin, "end": begin + n, "shard": shard, "base": used[shard]})
            used[shard] += n
            room[shard] -= n

    over = []
    for arc, owner in enumerate(owners):
        kept = min(counts[arc], room[owner])
        put(arc, 0, kept, owner)
        over.append(kept)
    for arc in range(arcs):
        at, step = over[arc], arc
        while at < counts[arc]:
            step = (step + 1) % arcs
            n = min(counts[arc] - at, room[owners[step]])
            put(arc, at, n, owners[step])
            at += n
    return ranges


def shard_rows(documents: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (its place in the shard, from 0), grown_shard (null)."""
    spark = documents.sparkSession
    points = ring(shards, virtual)
    owners = [shard for _, shard in points]
    arc = first_at_least(F.xxhash64("doc_id"), [p for p, _ in points]) % len(points)

    counts = [0] * len(points)
    for r in documents.select(arc.alias("arc")).groupBy("arc").count().collect():  # one row per virtual node
        counts[r["arc"]] = r["count"]
    ranges = walk(owners, counts, capacities(sum(counts), shards, slack))
    plan = literal_rows(spark, ranges, "arc int, begin bigint, end bigint, shard int, base bigint")

    rows = documents.select(
        "doc_id", arc.alias("arc"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    row = ["arc", "doc_id", "size", "text_crc32"]
    rows = rows.groupBy(*row).agg(F.count("*").alias("copies"))
    slices = literal_rows(spark, [{"arc": a, "slices": -(-n // SLICE_ROWS)} for a, n in enumerate(counts) if n], "arc int, slices int")
    at = F.xxhash64("doc_id", "size", "text_crc32")
    rows = rows.join(F.broadcast(slices), "arc").withColumn("slice", F.pmod(F.shiftright(at, 20), F.col("slices")).cast("int"))  # one row per arc
    before = (Window.unboundedPreceding, -1)
    sizes = rows.groupBy("arc", "slice").agg(F.sum("copies").alias("n"))
    start = F.sum("n").over(Window.partitionBy("arc").orderBy("slice").rowsBetween(*before))
    starts = sizes.select("arc", "slice", F.coalesce(start, F.lit(0)).alias("start"))
    inside = F.sum("copies").over(Window.partitionBy("arc", "slice").orderBy(at, *row[1:]).rowsBetween(*before))
    ranked = rows.withColumn("place", F.coalesce(inside, F.lit(0))).join(starts, ["arc", "slice"]).select(
        *row, (F.col("start") + F.col("place")).alias("first"), (F.col("start") + F.col("place") + F.col("copies")).alias("last")).alias("r")
    plan = F.broadcast(plan).alias("p")  # at most shards * virtual * 2 ranges
    met = (F.col("r.arc") == F.col("p.arc")) & (F.col("first") < F.col("end")) & (F.col("last") > F.col("begin"))
    since, until = F.greatest("first", "begin"), F.least("last", "end")
    blocks = ranked.join(plan, met).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + since - F.col("begin")).alias("slot"), (until - since).alias("n"),
    ).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / SLICE_ROWS))).alias("block"))
    done = F.col("block") * SLICE_ROWS
    own = blocks.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") + done).alias("from"), F.least(F.col("n") - done, F.lit(SLICE_ROWS)).alias("n"))
    return own.select(
        "doc_id", "size", "text_crc32", F.lit("rows" if slack == 0 else "bounded").alias("law"), "shard",
        F.explode(F.sequence("from", F.col("from") + F.col("n") - 1)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
