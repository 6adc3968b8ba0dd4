"""Exact and candidate duplicates, counted per group and flagged on every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.operators.skew import with_group_size


def _flag(count: str, several: str) -> Column:
    return F.when(F.col(count) > 1, several).otherwise("UNIQUE")


def exact_match(df: DataFrame, key: str = "ProviderID") -> DataFrame:
    """Rows per id on each row; all NULL ids form one group."""
    sized = with_group_size(df, [key], "EXACT_MATCH_COUNT")
    return sized.withColumn("EXACT_MATCH_STATUS", _flag("EXACT_MATCH_COUNT", "MATCH"))


def duplicate_flag(df: DataFrame, key: str = "ProviderID") -> DataFrame:
    """The exact-match count under its de-duplication name; reuses it when present."""
    if "EXACT_MATCH_COUNT" in df.columns:
        sized = df.withColumn("DUPLICATE_COUNT", F.col("EXACT_MATCH_COUNT"))
    else:
        sized = with_group_size(df, [key], "DUPLICATE_COUNT")
    return sized.withColumn("DUPLICATE_STATUS", _flag("DUPLICATE_COUNT", "DUPLICATE"))


def fuzzy_match(
    df: DataFrame,
    parts: tuple[str, ...] = ("PhoneNumber", "PostalCode"),
    compat: bool = False,
) -> DataFrame:
    """Candidate duplicates: rows sharing phone and postal code, flagged for review.

    By default a missing part means no key, so the row matches nothing. ``compat`` joins
    whatever parts are present, so rows without a phone match on postal code alone.
    """
    columns = [F.col(p) for p in parts]
    if compat:
        keyed = df.withColumn("FUZZY_MATCH_KEY", F.concat_ws("|", *columns))
        sized = with_group_size(keyed, ["FUZZY_MATCH_KEY"], "FUZZY_MATCH_COUNT")
    else:
        pieces = [columns[0]]
        for c in columns[1:]:
            pieces += [F.lit("|"), c]
        keyed = df.withColumn("FUZZY_MATCH_KEY", F.concat(*pieces))
        sized = with_group_size(
            keyed,
            ["FUZZY_MATCH_KEY"],
            "FUZZY_MATCH_COUNT",
            alone=F.col("FUZZY_MATCH_KEY").isNull(),
        )
    return sized.withColumn("FUZZY_MATCH_STATUS", _flag("FUZZY_MATCH_COUNT", "REVIEW"))
