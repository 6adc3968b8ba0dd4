"""Analyst reports and monitoring views over any table with the golden columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.operators.rules import QUALITY_OK
from goldrec.operators.skew import row_hash
from goldrec.schemas import AUDIT

Report = Callable[[DataFrame], DataFrame]


def total(df: DataFrame, measure: str = "TOTAL_PROVIDERS") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(measure))


def group_count(
    df: DataFrame,
    *by: str,
    measure: str = "TOTAL_PROVIDERS",
    order: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rows per group, NULL being a group of its own.

    The default order is largest first, ties by group. A name in ``order`` with a leading
    '-' sorts descending.
    """
    terms = order or (f"-{measure}",)
    named = [t.lstrip("-") for t in terms]
    ranked = [*terms, *[b for b in by if b not in named]]
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias(measure))
    return counted.orderBy(*[_sorted(t) for t in ranked])


def _sorted(term: str) -> Column:
    name = term.lstrip("-")
    return F.desc_nulls_last(name) if term.startswith("-") else F.asc_nulls_last(name)


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.asc_nulls_last(column))


def duplicate_ids(
    df: DataFrame, key: str = "ProviderID", measure: str = "DUPLICATE_COUNT"
) -> DataFrame:
    """Ids on more than one row; NULL ids count as one group."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(measure)).filter(F.col(measure) > 1)


def latest_batches(df: DataFrame) -> DataFrame:
    rows = df.select("BATCH_ID", "FILE_NAME", "LOAD_DATE").distinct()
    return rows.orderBy(_sorted("-LOAD_DATE"), _sorted("BATCH_ID"), _sorted("FILE_NAME"))


def newest_first(df: DataFrame, *columns: str) -> DataFrame:
    """All rows, newest load first.

    A load stamps all its rows alike, so the id and a content hash follow in the sort key;
    they keep the order fixed and let the range partitioner divide a large load.
    """
    ordered = df.orderBy(_sorted("-LOAD_TIMESTAMP"), _sorted("ProviderID"), row_hash(df))
    return ordered.select(*columns) if columns else ordered


def newest(df: DataFrame, n: int = 5) -> DataFrame:
    return df.orderBy(_sorted("-LOAD_TIMESTAMP"), _sorted("ProviderID"), row_hash(df)).limit(n)


def listing(df: DataFrame) -> DataFrame:
    return df.orderBy(_sorted("FullName"), _sorted("ProviderID"), row_hash(df))


def _count(*by: str, measure: str = "TOTAL_PROVIDERS", order: tuple[str, ...] | None = None) -> Report:
    return lambda df: group_count(df, *by, measure=measure, order=order)


_RECORDS = partial(_count, measure="TOTAL_RECORDS")

# The 35 analyst questions on the golden table. The measure names.
ANALYST: Mapping[str, Report] = {
    "q01_total": total,
    "q02_status": _count("Status"),
    "q03_state": _count("State"),
    "q04_country": _count("CountryCode"),
    "q05_gender": _count("Gender"),
    "q06_credential": _count("Credential"),
    "q07_city": _count("City"),
    "q08_rules": _RECORDS("BUSINESS_RULE_STATUS"),
    "q09_dq": _RECORDS("DATA_QUALITY_WARNING"),
    "q10_batches": latest_batches,
    "q11_source": _count("SOURCE_SYSTEM"),
    "q12_format": _count("PAYLOAD_FORMAT"),
    "q13_target": _count("TARGET_SYSTEM"),
    "q14_recent": lambda df: newest_first(df, "ProviderID", "FullName", "State", "LOAD_TIMESTAMP"),
    "q15_dups": duplicate_ids,
    "q16_no_phone": lambda df: missing(df, "PhoneNumber"),
    "q17_no_license": lambda df: missing(df, "LicenseNumber"),
    "q18_no_taxonomy": lambda df: missing(df, "TaxonomyCode"),
    "q19_listing": listing,
    "q20_batch": _RECORDS("BATCH_ID"),
    "q21_taxonomy": _count("TaxonomyCode"),
    "q22_postal": _count("PostalCode"),
    "q23_license": _count("LicenseNumber"),
    "q24_file": _RECORDS("FILE_NAME"),
    "q25_load_date": _RECORDS("LOAD_DATE", order=("-LOAD_DATE",)),
    "q26_top5": newest,
    "q27_no_address": lambda df: missing(df, "AddressLine1"),
    "q28_no_identifier": lambda df: missing(df, "Identifier"),
    "q29_states": lambda df: distinct_values(df, "State"),
    "q30_cities": lambda df: distinct_values(df, "City"),
    "q31_credentials": lambda df: distinct_values(df, "Credential"),
    "q32_taxonomies": lambda df: distinct_values(df, "TaxonomyCode"),
    "q33_state_rules": _RECORDS("State", "BUSINESS_RULE_STATUS", order=("State",)),
    "q34_state_dq": _RECORDS("State", "DATA_QUALITY_WARNING", order=("State",)),
    "q35_state_gender": _count("State", "Gender", order=("State", "-TOTAL_PROVIDERS")),
}


# Monitoring ---------------------------------------------------------------------------


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named table, one row each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("TOTAL_RECORDS")).select(
            F.lit(name).alias("LAYER"), "TOTAL_RECORDS"
        )
        for name, df in layers.items()
    ]
    combined = counts[0]
    for c in counts[1:]:
        combined = combined.unionByName(c)
    return combined


def sample_rows(df: DataFrame, n: int = 10, order: Sequence[str] = ("ProviderID", "BATCH_ID")) -> DataFrame:
    """The first rows by the given columns; which rows are shown is then the same every time."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def audit_columns(df: DataFrame, n: int = 50) -> DataFrame:
    return df.select(*AUDIT).orderBy(*[F.asc_nulls_last(c) for c in ("LOAD_TIMESTAMP", "FILE_NAME", "BATCH_ID")]).limit(n)


# The columns whose distribution is monitored on landing and gold.
DISTRIBUTIONS = (
    "SOURCE_SYSTEM",
    "CountryCode",
    "State",
    "BUSINESS_RULE_STATUS",
    "DATA_QUALITY_WARNING",
)


def distributions(df: DataFrame, columns: tuple[str, ...] = DISTRIBUTIONS) -> DataFrame:
    """Rows per value of several columns in one pass and one shuffle."""
    pairs = [
        F.struct(F.lit(c).alias("ATTRIBUTE"), F.col(c).cast("string").alias("VALUE")) for c in columns
    ]
    # Count whole combinations first: only their few sums are unpivoted.
    combined = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return (
        combined.select(F.explode(F.array(*pairs)).alias("_p"), "_n")
        .groupBy("_p.ATTRIBUTE", "_p.VALUE")
        .agg(F.sum("_n").alias("TOTAL_RECORDS"))
    )


def quality_issues(df: DataFrame, compat: bool = False) -> DataFrame:
    """Rows with a warning. ``compat`` keeps every row that has any text in the column."""
    warned = F.col("DATA_QUALITY_WARNING").isNotNull()
    return df.filter(warned if compat else warned & (F.col("DATA_QUALITY_WARNING") != QUALITY_OK))


def failed_rules(df: DataFrame) -> DataFrame:
    return df.filter(F.col("BUSINESS_RULE_STATUS") != "PASS")


def export_audit(log: DataFrame, batch_id: str | None = None) -> DataFrame:
    """The export log newest first, or the attempts of one batch."""
    rows = log if batch_id is None else log.filter(F.col("BATCH_ID") == batch_id)
    return rows.orderBy(F.desc_nulls_last("EXPORT_TIMESTAMP"), "BATCH_ID")


# Columns each review sample shows, with the filter that selects its rows. The columns shown.
REVIEWS = {
    "match": (
        "EXACT_MATCH_STATUS = 'MATCH'",
        ("ProviderID", "FirstName", "FullName", "EXACT_MATCH_COUNT", "EXACT_MATCH_STATUS"),
    ),
    "fuzzy": (
        "FUZZY_MATCH_STATUS = 'REVIEW'",
        ("ProviderID", "FirstName", "FullName", "PhoneNumber", "PostalCode", "FUZZY_MATCH_KEY",
         "FUZZY_MATCH_COUNT", "FUZZY_MATCH_STATUS"),
    ),
    "duplicate": (
        "DUPLICATE_STATUS = 'DUPLICATE'",
        ("ProviderID", "FirstName", "LastUpdated", "DUPLICATE_COUNT", "DUPLICATE_STATUS"),
    ),
    "rules": (
        "true",
        ("ProviderID", "Status", "CountryCode", "BUSINESS_RULE_STATUS", "BUSINESS_RULE_MESSAGE"),
    ),
    "quality": (
        "true",
        ("ProviderID", "FirstName", "MiddleName", "LastName", "FullName", "PhoneNumber",
         "LicenseNumber", "Identifier", "DATA_QUALITY_WARNING"),
    ),
    "survivors": (
        "DUPLICATE_STATUS = 'DUPLICATE'",
        ("ProviderID", "FirstName", "Status", "LastUpdated", "SURVIVOR_RANK", "SURVIVOR_STATUS"),
    ),
}


def review_sample(df: DataFrame, name: str, n: int = 20, order: tuple[str, ...] | None = None) -> DataFrame:
    """The first ``n`` flagged rows, in a fixed order so that a review can be repeated."""
    condition, columns = REVIEWS[name]
    terms = [F.asc_nulls_last(c) for c in (order or columns)]
    return df.filter(condition).orderBy(*terms).select(*columns).limit(n)
