"""Exact per-group work that survives a group holding a large share of all rows.

There is one plan for every size, and no job runs while it is built. Counts are combined before
their shuffle and joined back; adaptive execution splits the partition of a large group. Ranks are
taken within slices of a group, cut at values of the sort columns themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000  # distinct rows of a group for each cut, and copies written out by one task
MOST_CUTS = 4_096  # cuts of one group; beyond, the slices grow with it
SALTS = 1_024  # spreads rows that belong to no group


def row_hash(df: DataFrame) -> Column:
    """Content hash of a row: the same on every attempt, so safe to shuffle on."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def with_group_size(df: DataFrame, keys: Sequence[str], out: str, alone: Column | None = None) -> DataFrame:
    """Attach the number of rows in each row's group (NULLs group together).

    Rows where ``alone`` holds belong to no group and count 1; they are spread over all tasks.
    """
    salt = F.lit(0) if alone is None else F.when(alone, F.pmod(row_hash(df), F.lit(SALTS)) + 1).otherwise(0)
    rows = df.withColumn("_salt", salt)
    sizes = (rows if alone is None else rows.filter("_salt = 0")).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], F.lit(0).alias("_gs"), "_n")
    on = F.col("_salt") == F.col("_gs")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    size = F.coalesce("_n", F.lit(1).cast("long"))
    return rows.join(sizes, on, "left").select(*df.columns, size.alias(out))


def _ahead(cuts: Column, value: Column) -> Column:
    """How many of the ascending cuts are above the value; 0 without cuts."""
    n = F.coalesce(F.size(cuts), F.lit(0))
    begin = F.struct(F.lit(0).alias("lo"), n.alias("hi"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        above = F.coalesce(F.get(cuts, middle) > value, F.lit(False))
        open_ = at["lo"] < at["hi"]
        return F.struct(
            F.when(open_ & ~above, middle + 1).otherwise(at["lo"]).alias("lo"),
            F.when(open_ & above, middle).otherwise(at["hi"]).alias("hi"),
        )

    # expected cuts are at most MOST_CUTS; more steps leave room for chance
    steps = F.sequence(F.lit(1), F.lit(MOST_CUTS.bit_length() + 4))
    return F.when(cuts.isNull(), 0).otherwise(n - F.aggregate(steps, begin, halve)["lo"])


def with_group_rank(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    out: str,
    unique: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Attach each row's 1-based position in its group, all ``order`` columns descending.

    The last order column breaks ties; ``unique`` says that it never repeats within a group.
    Otherwise copies of a row are first counted into one and written out again in blocks.

    A group of n distinct rows is cut at about ``n / slice_rows`` of its own sort tuples, chosen
    by their hash. A row's place is its place in its slice plus the sizes of the slices ahead.
    """
    columns = df.columns
    rows = df.withColumn("_copies", F.lit(1).cast("long")) if unique else (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    )
    # Plain key columns instead of a NULL-safe comparison, so that joins and windows share shuffles.
    group = ["_null", "_key"]
    rows = rows.withColumns({
        "_null": F.col(key).isNull(),
        "_key": F.coalesce(F.col(key).cast("string"), F.lit("")),
        "_tuple": F.struct(*[F.col(c).alias(f"_t{i}") for i, c in enumerate(order)]),
    })
    wanted = F.least(F.floor(F.col("_rows") / slice_rows), F.lit(MOST_CUTS))
    large = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > slice_rows)
    chance = F.shiftrightunsigned(F.xxhash64("_tuple"), 11) / F.lit(2.0**53)
    cuts = (
        rows.select(*group, "_tuple").join(large.select(*group, (wanted / F.col("_rows")).alias("_rate")), group)
        .filter(chance < F.col("_rate"))
        .groupBy(*group).agg(F.sort_array(F.collect_list("_tuple")).alias("_cuts"))
    )
    rows = rows.join(cuts, group, "left").withColumn("_slice", _ahead(F.col("_cuts"), F.col("_tuple"))).drop("_cuts", "_tuple")

    before = (Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*group, "_slice").agg(F.sum("_copies").alias("_size"))
    slices = Window.partitionBy(*group).orderBy("_slice").rowsBetween(*before)
    starts = sizes.select(*group, "_slice", F.sum("_size").over(slices).alias("_start"))
    inner = Window.partitionBy(*group, "_slice").orderBy(*[F.desc_nulls_last(c) for c in order])
    placed = (
        rows.withColumn("_in", F.sum("_copies").over(inner.rowsBetween(*before)))
        .join(starts, [*group, "_slice"], "left")
        .withColumn("_first", F.coalesce("_start", F.lit(0)) + F.coalesce("_in", F.lit(0)) + 1)
    )
    if unique:
        return placed.select(*columns, F.col("_first").alias(out))
    block = F.lit(slice_rows).cast("long")
    blocks = placed.select(
        *columns,
        "_first",
        "_copies",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / block))).alias("_block"),
    ).hint("rebalance")
    start = F.col("_first") + F.col("_block") * block
    end = F.least(start + block, F.col("_first") + F.col("_copies")) - 1
    return blocks.select(*columns, F.explode(F.sequence(start, end)).alias(out))


def restrict(df: DataFrame, keys: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join of rows against a list of keys such as batch ids.

    Adaptive execution broadcasts a list that it has measured to be short and splits a key with
    most of the rows. A NULL key matches nothing.
    """
    return df.join(keys.select(*on), list(on), how).select(*df.columns)
