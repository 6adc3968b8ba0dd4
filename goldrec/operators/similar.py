"""Values that are nearly equal, by the declared precision of a field, within blocks of records.

Two values pass when their edit distance is at most the share of the longer one that the precision
leaves: t = floor((100 - precision) * length / 100). A value is cut into pieces; t edits touch t of
them at most, so of any t + 1 pieces one stands in the other value as it is, moved by at most t
places. The t + 1 pieces that the fewest values of the block have are looked up, so a beginning that
all values share brings nobody together. What is found that way is then measured.

Equal values are one class with a count, and pairs are pairs of classes: a block that holds a third of
all records costs its distinct values, and no pair of equal records is written out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.schemas import FIELD_CONFIG, FieldMatch

BLOCK = ("PhoneNumber", "PostalCode")


def _edits(length: Column, precision: int) -> Column:
    """The most edits that a pair whose longer value has this length may have."""
    return F.floor(length * (100 - precision) / 100).cast("int")


def _pieces(length: Column, precision: int) -> Column:
    return F.least(length, 2 * (_edits(length, precision) + 1))


def _cut(length: Column, i: Column, pieces: Column) -> Column:
    """Where piece i of a value of this length starts."""
    return F.floor(i * length / pieces).cast("int")


def similarity(a: Column, b: Column) -> Column:
    """100 for equal values, less by the share of the longer one that has to be edited."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 100.0).otherwise(F.round(100 * (longer - F.levenshtein(a, b)) / longer, 6))


def value_classes(df: DataFrame, field: str, block: Sequence[str] = BLOCK) -> DataFrame:
    """block columns, VALUE, RECORDS: one row for each distinct value of a block. NULLs match nothing."""
    present = df.dropna(subset=[field, *block])
    return present.groupBy(*block, F.col(field).alias("VALUE")).agg(F.count(F.lit(1)).alias("RECORDS"))


def similar_values(df: DataFrame, field: str, precision: int, block: Sequence[str] = BLOCK) -> DataFrame:
    """Pairs of different values of a block that pass: block columns, VALUE_A, VALUE_B, RECORDS_A, RECORDS_B, SIMILARITY.

    VALUE_A is the shorter value, or the one that sorts first.
    """
    classes = value_classes(df, field, block)
    size, i, moved = F.col("_size"), F.col("_i"), F.col("_moved")
    pieces, start = _pieces(size, precision), _cut(size, i, _pieces(size, precision))
    length = _cut(size, i + 1, pieces) - start
    place = [*block, "_size", "_i", "_piece"]

    cut = (
        classes.withColumn("_size", F.length("VALUE")).filter(_edits(size, precision) > 0)
        .select(*block, "VALUE", "_size", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_i"))
        .withColumn("_piece", F.substr("VALUE", start + 1, length))
    )
    common = cut.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    rarest = Window.partitionBy(*block, "VALUE").orderBy("_n", "_i")
    looked_up = (
        cut.join(common, place).withColumn("_rank", F.row_number().over(rarest))
        .filter(F.col("_rank") <= _edits(size, precision) + 1)
        .select(*place, F.col("VALUE").alias("VALUE_B"))
    )

    own, edits = F.length("VALUE"), _edits(size, precision)
    # what an untouched piece is moved by comes from edits ahead of it; the rest of the change in length needs edits behind it
    reach = F.abs(moved) + F.abs(own - size - moved) <= edits
    inside = (start + moved >= 0) & (start + moved + length <= own)
    standing = (
        classes.select(*block, "VALUE", F.explode(F.sequence(own, F.floor(own * 100 / precision).cast("int"))).alias("_size"))
        .filter((edits > 0) & (size - own <= edits))
        .select("*", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_i"))
        .select("*", F.explode(F.sequence(-edits, edits)).alias("_moved"))
        .filter(reach & inside)
        .select(*block, "_size", "_i", F.substr("VALUE", start + moved + 1, length).alias("_piece"), F.col("VALUE").alias("VALUE_A"))
        .distinct()
    )
    a, b = F.col("VALUE_A"), F.col("VALUE_B")
    met = standing.join(looked_up, place).filter((F.length(a) < F.length(b)) | (a < b))
    passed = met.select(*block, "VALUE_A", "VALUE_B").distinct().filter(
        F.levenshtein(a, b) <= _edits(F.length(b), precision))
    for side in ("A", "B"):
        named = classes.select(*block, F.col("VALUE").alias(f"VALUE_{side}"), F.col("RECORDS").alias(f"RECORDS_{side}"))
        passed = passed.join(named, [*block, f"VALUE_{side}"])
    return passed.select(*block, "VALUE_A", "VALUE_B", "RECORDS_A", "RECORDS_B", similarity(a, b).alias("SIMILARITY"))


def similar_records(df: DataFrame, key: str, field: str, precision: int, block: Sequence[str] = BLOCK) -> DataFrame:
    """Per record: key, block columns, VALUE, and how many other records of the block pass: equal ones, nearly equal ones."""
    pairs = similar_values(df, field, precision, block)
    linked = pairs.select(*block, F.col("VALUE_A").alias("VALUE"), F.col("RECORDS_B").alias("_n")).unionByName(
        pairs.select(*block, F.col("VALUE_B").alias("VALUE"), F.col("RECORDS_A").alias("_n")))
    near = linked.groupBy(*block, "VALUE").agg(F.sum("_n").alias("_near"))
    counted = value_classes(df, field, block).join(near, [*block, "VALUE"], "left").select(
        *block, "VALUE", (F.col("RECORDS") - 1).alias("EQUAL_RECORDS"), F.coalesce("_near", F.lit(0).cast("long")).alias("SIMILAR_RECORDS"))
    records = df.select(key, *block, F.col(field).alias("VALUE"))
    zero = F.lit(0).cast("long")
    return records.join(counted, [*block, "VALUE"], "left").select(
        key, *block, "VALUE", *[F.coalesce(c, zero).alias(c) for c in ("EQUAL_RECORDS", "SIMILAR_RECORDS")])


def score_fields(df: DataFrame, block: Sequence[str] = BLOCK, config: Sequence[FieldMatch] = FIELD_CONFIG) -> DataFrame:
    """``similar_values`` of every configured FUZZY field that the records have, under its name (FIELD)."""
    found = None
    for field in config:
        if field.method == "FUZZY" and field.name in df.columns:
            part = similar_values(df, field.name, field.precision, block).select(F.lit(field.name).alias("FIELD"), "*")
            found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("none of the configured FUZZY fields is a column")
    return found


def _is(kind: str):
    return lambda v: v["verdict"] == kind


def score_pairs(pairs: DataFrame, a: str = "a", b: str = "b", config: Sequence[FieldMatch] = FIELD_CONFIG) -> DataFrame:
    """Pairs of records, given as two structs, with the fields that pass (PASSED), fail (FAILED), or lack a value (MISSING)."""
    held = {f for f in pairs.schema[a].dataType.names if f in pairs.schema[b].dataType.names}
    verdicts = []
    for field in (f for f in config if f.name in held):
        x, y = F.col(a)[field.name], F.col(b)[field.name]
        passes = x == y if field.method == "EXACT" else similarity(x, y) >= field.precision
        verdict = F.when(x.isNull() | y.isNull(), "MISSING").when(passes, "PASSED").otherwise("FAILED")
        verdicts.append(F.struct(F.lit(field.name).alias("name"), verdict.alias("verdict")))
    return pairs.withColumn("_v", F.array(*verdicts)).select(*pairs.columns, *[
        F.transform(F.filter("_v", _is(kind)), lambda v: v["name"]).alias(kind)
        for kind in ("PASSED", "FAILED", "MISSING")])
