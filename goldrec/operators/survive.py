"""Survivorship: pick one row per id by declared preference."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.operators.rules import QUALITY_RULES, Rule, fill_full_name, quality_warning, rule_status, rules_for
from goldrec.operators.skew import SLICE_ROWS, row_hash, with_group_rank
from goldrec.schemas import GOLD_COLUMNS


@dataclass(frozen=True)
class Survivorship:
    """Which row of an id wins: status, then newest date, then the tie-break.

    ``tie`` names an integral column unique within an id. Without one, the newest load
    time wins and a content hash settles the rest, so the order is always total.
    ``compat`` sorts the status text descending, which puts 'I' before 'A'.
    """

    key: str = "ProviderID"
    preferred: str = "A"
    date: str = "LastUpdated"
    tie: str | None = None
    compat: bool = False

    def order(self, df: DataFrame) -> dict[str, Column]:
        """Sort columns by working name; every one sorts descending, NULLs last."""
        status = F.col("Status")
        terms = {
            "_o_status": status if self.compat else status.eqNullSafe(self.preferred).cast("int"),
            "_o_date": F.try_to_date(F.col(self.date)),
        }
        if self.tie:
            terms["_o_tie"] = F.col(self.tie)
        else:
            if "LOAD_TIMESTAMP" in df.columns:
                terms["_o_load"] = F.col("LOAD_TIMESTAMP")
            terms["_o_tie"] = row_hash(df)
        return terms


def survivor_rank(
    df: DataFrame, policy: Survivorship = Survivorship(), slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Rank and status of every row: rank 1 is the survivor, the others are discarded."""
    terms = policy.order(df)
    ranked = with_group_rank(
        df.withColumns(terms),
        policy.key,
        list(terms),
        "SURVIVOR_RANK",
        unique=policy.tie is not None,
        slice_rows=slice_rows,
    ).drop(*terms)
    status = F.when(F.col("SURVIVOR_RANK") == 1, "SURVIVOR").otherwise("DISCARDED")
    return ranked.withColumn("SURVIVOR_STATUS", status)


def survivors(df: DataFrame, policy: Survivorship = Survivorship()) -> DataFrame:
    """One row per id; all NULL ids give one row.

    The rank filter lets Spark keep only the best row of each id before the shuffle, so a
    hot id costs one row per input partition.
    """
    terms = policy.order(df)
    window = Window.partitionBy(policy.key).orderBy(*[F.desc_nulls_last(t) for t in terms])
    ranked = df.withColumns(terms).withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").drop("_rank", *terms)


def golden_record(
    df: DataFrame,
    policy: Survivorship = Survivorship(),
    rules: tuple[Rule, ...] | None = None,
    quality: tuple[Rule, ...] = QUALITY_RULES,
) -> DataFrame:
    """The 23-column golden record. Flags are set on survivors only; they do not rank."""
    best = survivors(fill_full_name(df), policy)
    flagged = rule_status(best, rules or rules_for(policy.compat))
    return quality_warning(flagged, quality).select(*GOLD_COLUMNS)
