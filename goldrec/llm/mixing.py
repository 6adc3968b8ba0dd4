"""Mixing sources to target weights by a low-discrepancy schedule.

Every slot of the mix is a golden-ratio point mapped through the cumulative weights to a source;
the slots of a source are ranked, and rank r takes the r-th block of that source's stream. A
stream is the source's documents in hash order, cut into blocks of equally many words, and runs
twice, in a new order the second time. So any stretch of the mix has the wanted shares.

A block is ``BLOCK`` words, so the slots grow with the words. The points say in which order the blocks
come, and with them the documents: the report has the slot at which a row's first words come, and
each task writes its documents of the mix, dealt by a hash, in the order of their slots. A source has as many slots as its
target fills, the last of them in part. Points that a source has too many go unused, those that it
lacks (a few per source) follow at the end of the mix. Each source with words takes its target, rounded,
and one word at least. Places in a stream are sums over hash buckets plus a running sum within a
bucket of about ``BUCKET_ROWS`` rows, and ranks of slots are counted in runs of ``RUN`` slots, so a source of
any size is spread.

Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and share ``share`` times all
words; a target stops at ``most`` times the words of its source and the excess is shared by weight
among the others, until none is above. Null and blank texts have no words and take none. Equal
ids and repeated rows are placed one by one and may take unlike amounts; ties of the hash order go by id,
text and size. A very long text lies in many blocks and is one row of the stream. An empty table gives no
rows. The report ignores other columns, the documents of the mix keep them.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.llm.common import written

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
BLOCK, BUCKET_ROWS, RUN = 1_024, 2_000, 65_536
#: Fractional part of the golden ratio, in units of 2**-32: the next slot's point is so far ahead.
GOLDEN = 2_654_435_769
ROW = ("doc_id", "source", "size", "digest")
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target from source and source_size: one row per source.

    A source is full if its cap over its weight is below the level at which the rest share what
    is left. Sources in order of that ratio are full up to some point, so sums up to each tell.
    """
    listed = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.row_number().over(listed) - 1) % len(WEIGHTS) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the first source that isn't full sets the level of all after it
    rows = rows.withColumn("nth", F.row_number().over(by_ratio)).withColumn("level", level)
    full = F.col("cap") <= F.col("level") * F.col("weight")
    first = F.min(F.when(~full, F.struct("nth", "level"))).over(everything)
    return rows.withColumn("share_level", first["level"]).select(
        "source", "source_size",
        F.least("cap", F.coalesce(F.col("share_level") * F.col("weight"), F.col("cap"))).alias("target"))


def streams(documents: DataFrame, passes: int = MOST) -> DataFrame:
    """row columns, pass (0, 1), offset: where each document begins in its source's stream."""
    buckets = documents.groupBy("source").agg(F.ceil(F.count("*") / BUCKET_ROWS).cast("int").alias("n")).select(F.col("source").alias("c"), "n")
    rows = documents.join(buckets, F.col("source").eqNullSafe(F.col("c"))).drop("c")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass"))
    rows = rows.withColumn("order", F.xxhash64("pass", "doc_id", "digest")).withColumn(
        "bucket", F.pmod(F.shiftright("order", 32), F.col("n")).cast("int")).drop("n")
    sums = rows.groupBy("source", "pass", "bucket").agg(F.sum("size").alias("words"))
    ahead = F.sum("words").over(
        Window.partitionBy("source").orderBy("pass", "bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("s"), F.col("pass").alias("p"), F.col("bucket").alias("b"),
                       F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "pass", "bucket").orderBy("order", "doc_id", "digest", "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("running", F.coalesce(running, F.lit(0)))
    return (rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("pass") == F.col("p")) & (F.col("bucket") == F.col("b")))
            .withColumn("offset", F.col("ahead") + F.col("running")).drop("s", "p", "b", "ahead", "running", "order", "bucket"))


def blocks(goals: DataFrame, slots: int | None = None) -> tuple[int, float]:
    """How many slots there are, and the words of a block: ``BLOCK``, or what a given number of slots makes of it."""
    total = goals.agg(F.sum("target")).first()[0] or 0.0
    return (slots, max(1.0, total / slots)) if slots else (math.ceil(total / BLOCK), float(BLOCK))


def words_wanted() -> Column:
    """The words that a source takes: its target, rounded, and one at least; 0 without a target."""
    return F.when(F.col("target") > 0, F.greatest(F.lit(1), F.round("target"))).otherwise(0).cast("long")


def schedule(goals: DataFrame, slots: int | None = None) -> DataFrame:
    """slot, source, rank (of the slot within its source), block (words): the mix, in order."""
    spark = goals.sparkSession
    n_slots, words = blocks(goals, slots)
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    total = F.sum("target").over(Window.partitionBy())
    shares = goals.where("target > 0").select(
        "source", total.alias("total"), (F.sum("target").over(ordered) / total).alias("upto"),
        ((F.sum("target").over(ordered) - F.col("target")) / total).alias("above"))
    # with fewer words than slots, a block is one word and the rest of the slots stay unused
    point = (F.pmod(F.col("id") * GOLDEN, F.lit(2**32)) + 0.5) / F.lit(float(2**32))
    # cells of the unit interval make the range join an equal join
    cells = 1_024
    shares = shares.select("*", F.explode(F.sequence(
        F.floor(F.col("above") * cells).cast("int"), F.least(F.floor(F.col("upto") * cells), F.lit(cells - 1)).cast("int"))).alias("cell"))
    points = spark.range(n_slots).select("id", point.alias("point"), F.floor(point * cells).cast("int").alias("cell"))
    hit = points.join(shares, "cell").where((F.col("id") < F.col("total")) & (F.col("point") >= F.col("above")) & (F.col("point") < F.col("upto")))
    hit = hit.select(F.col("id").alias("slot"), "source", F.floor(F.col("id") / RUN).alias("run"))
    # a slot's rank is its place in its run and the source's slots in the runs before
    counts = hit.groupBy("source", "run").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("source").alias("s"), F.col("run").alias("r"), F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("source", "run").orderBy("slot"))
    hit = hit.withColumn("place", place).join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r"))).select(
        "slot", "source", (F.col("before") + F.col("place")).cast("long").alias("rank"))
    needs = goals.where("target > 0").select(F.col("source").alias("s"), F.lit(words).alias("block"), words_wanted().alias("wanted"))
    # blocks that begin before the last wanted word
    needs = needs.withColumn("need", F.floor((F.col("wanted") - 1) / F.col("block")) + 1)
    own = hit.join(needs, F.col("source").eqNullSafe(F.col("s"))).where("rank <= need").select("slot", "source", "rank", "block")
    have = counts.groupBy("source").agg(F.sum("n").alias("have"))
    lacking = needs.join(have, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < need")
    lacking = lacking.select(F.col("s").alias("source"), F.explode(F.sequence(F.col("have") + 1, F.col("need"))).alias("rank"), "block")
    at = F.row_number().over(Window.orderBy("rank", F.col("source").isNull(), "source"))
    return own.unionByName(lacking.select((at - 1 + n_slots).cast("long").alias("slot"), "source", "rank", "block"))


def prepared(documents: DataFrame, *keep: str) -> DataFrame:
    return documents.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                            F.xxhash64("text").alias("digest"), *keep)


def mixture(rows: DataFrame, slots: int | None = None, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix: rows as :func:`prepared` makes them, with source_size, target, pass, slot, taken.

    A document meets the blocks that its words lie in, and each block its slot: one row for each
    slot that takes words of the document in that pass, in all passes a leading part of it. Slot is
    null and taken 0 where the schedule ends before the document.
    """
    goals = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, most).coalesce(1), "goals")
    words_of_block = blocks(goals, slots)[1]
    plan = schedule(goals, slots).select("slot", F.col("source").alias("s"), F.col("rank") - 1, "block").toDF("slot", "s", "nth", "b")
    goals = goals.select(F.col("source").alias("g"), "source_size", "target", F.lit(words_of_block).alias("block"), words_wanted().alias("wanted"))
    placed = streams(rows, most).join(goals, F.col("source").eqNullSafe(F.col("g"))).drop("g")
    first = F.greatest(F.floor(F.col("offset") / F.col("block")) - 1, F.lit(0))
    last = F.floor((F.col("offset") + F.col("size")) / F.col("block")) + 1
    pieces = placed.select("*", F.explode(F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))).alias("nth_block"))
    edge = lambda nth: F.ceil(nth * F.col("block"))
    words = (F.least(F.col("offset") + F.col("size"), edge(F.col("nth_block") + 1))
             - F.greatest("offset", edge(F.col("nth_block"))))
    pieces = pieces.withColumn("words", words).where("words > 0 or size = 0")
    # the last block of a source is taken in part
    over = F.greatest(F.lit(0), F.least(F.col("offset") + F.col("size"), edge(F.col("nth_block") + 1)) - F.col("wanted"))
    left = F.greatest(F.lit(0), F.col("words") - over)
    met = pieces.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("nth_block") == F.col("nth")), "left")
    return met.select(*rows.columns, "source_size", "target", "pass", "slot",
                      F.when(F.col("slot").isNull(), 0).otherwise(left).cast("long").alias("taken"))


def takes(documents: DataFrame, label: str = "mix") -> DataFrame:
    """doc_id, source, size, digest, source_size, target, nth, pass, slot, taken: one row per row and pass.

    A row's pieces meet again by id, source and text; ``slot`` is the first that takes words of it.
    Rows that repeat in full are told apart by ``nth``, from 0, and share what they take, whole
    documents first.
    """
    rows = written(prepared(documents), label)  # read several times below, the texts once
    copies = rows.groupBy(*ROW).agg(F.count("*").alias("copies")).toDF(*(f"r_{c}" for c in ROW), "copies")
    per = mixture(rows).groupBy(*ROW, "source_size", "target", "pass").agg(F.sum("taken").alias("all"), F.min("slot").alias("slot"))
    per = per.join(copies, reduce(and_, (F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in ROW)))
    per = per.select(*ROW, "source_size", "target", "pass", "slot", "all", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("nth"))
    own = F.greatest(F.lit(0), F.least("size", F.col("all") - F.col("nth") * F.col("size")))
    return per.withColumn("taken", own.cast("long")).drop("all")


def mix_report(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, slot (where its first words come; null without any): one row per row of the input."""
    first = F.min(F.when(F.col("taken") > 0, F.col("slot"))).alias("slot")
    return (takes(documents).groupBy(*ROW, "source_size", "target", "nth").agg(F.sum("taken").alias("taken"), first)
            .select("doc_id", "size", "source_size", "target", "taken", "slot"))


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The mix as documents, each task's in the order of their slots: a row for each pass that takes words of a row, with the words it takes.

    The columns are those of the input, n_chars is counted anew. A document taken whole keeps its
    text; the last one of its source may give a leading part, its words one blank apart.
    """
    part = takes(documents).where("taken > 0").select(*(F.col(c).alias(f"t_{c}") for c in ROW), F.col("nth").alias("t_nth"), F.col("slot").alias("t_slot"), "taken")
    keys = ["doc_id", "source", "digest", "size"]
    rows = documents.withColumn("digest", F.xxhash64("text")).withColumn("size", word_count(F.col("text")))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))) - 1)
    met = rows.join(part, reduce(and_, (F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in [*keys, "nth"])))
    text = F.when(F.col("taken") == F.col("size"), F.col("text")).otherwise(
        F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("taken").cast("int")), " "))
    met = met.withColumn("text", text)
    if "n_chars" in documents.columns:
        met = met.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    in_order = met.select(*documents.columns, F.col("t_slot").alias("_slot")).sortWithinPartitions("_slot")
    return in_order.drop("_slot")
