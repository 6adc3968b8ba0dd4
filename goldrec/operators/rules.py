"""Business rules and data-quality flags. Rows are flagged, never removed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.functions.text import first_hit


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when the SQL condition ``broken`` is true."""

    code: str
    broken: str
    message: str


# Rule messages, in the order the rules are checked.
BUSINESS_RULES = (
    Rule("BR-001", "ProviderID IS NULL", "ProviderID is missing"),
    Rule("BR-002", "NOT (Status <=> 'A')", "Inactive Provider"),
    Rule("BR-003", "TaxonomyCode IS NULL", "TaxonomyCode is missing"),
    Rule("BR-004", "NOT (CountryCode <=> 'US')", "Invalid Country"),
)

# Same rules, but a NULL status or country does not break its rule.
LENIENT_RULES = (
    BUSINESS_RULES[0],
    Rule("BR-002", "Status <> 'A'", "Inactive Provider"),
    BUSINESS_RULES[2],
    Rule("BR-004", "CountryCode <> 'US'", "Invalid Country"),
)

RULES_OK = "Business rules passed"

# Quality warnings, in the order the attributes are checked.
QUALITY_RULES = (
    Rule("DQ-001", "PhoneNumber IS NULL", "PhoneNumber Missing"),
    Rule("DQ-002", "LicenseNumber IS NULL", "LicenseNumber Missing"),
    Rule("DQ-003", "Identifier IS NULL", "Identifier Missing"),
)

QUALITY_OK = "No Data Quality Issues"


def rules_for(compat: bool) -> tuple[Rule, ...]:
    return LENIENT_RULES if compat else BUSINESS_RULES


def rule_status(df: DataFrame, rules: tuple[Rule, ...] = BUSINESS_RULES) -> DataFrame:
    cases = [(F.expr(r.broken), "FAIL") for r in rules]
    return df.withColumn("BUSINESS_RULE_STATUS", first_hit(cases, "PASS"))


def rule_message(df: DataFrame, rules: tuple[Rule, ...] = BUSINESS_RULES) -> DataFrame:
    cases = [(F.expr(r.broken), r.message) for r in rules]
    return df.withColumn("BUSINESS_RULE_MESSAGE", first_hit(cases, RULES_OK))


def quality_warning(df: DataFrame, rules: tuple[Rule, ...] = QUALITY_RULES) -> DataFrame:
    cases = [(F.expr(r.broken), r.message) for r in rules]
    return df.withColumn("DATA_QUALITY_WARNING", first_hit(cases, QUALITY_OK))


def fill_full_name(df: DataFrame) -> DataFrame:
    """Build a missing or empty FullName from the name parts that are not NULL."""
    parts = [F.col(c) for c in ("FirstName", "MiddleName", "LastName")]
    built = F.concat_ws(" ", *parts)
    return df.withColumn("FullName", F.coalesce(F.nullif("FullName", F.lit("")), built))
