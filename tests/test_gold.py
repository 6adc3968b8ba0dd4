"""Rules, matching and survivorship on small frames."""

import pytest
from pyspark.sql import functions as F

from goldrec.operators.matching import fuzzy_match
from goldrec.operators.rules import (
    LENIENT_RULES, fill_full_name, quality_warning, rule_message, rule_status,
)
from goldrec.operators.survive import Survivorship, golden_record, survivor_rank, survivors
from goldrec.plans.provider_view import provider_src
from goldrec.schemas import ATTRIBUTES, FIELD_CONFIG, GOLD_COLUMNS, SILVER_COLUMNS
from tests.conftest import rows


def test_contracts():
    assert (len(ATTRIBUTES), len(SILVER_COLUMNS), len(GOLD_COLUMNS)) == (25, 32, 23)
    assert [f.name for f in FIELD_CONFIG if f.method == "FUZZY"] == [
        "FullName", "AddressLine1", "City", "TaxonomyDescription",
    ]


CASES = [
    # id, status, taxonomy, country -> message, lenient message
    (None, "A", "T", "US", "ProviderID is missing", "ProviderID is missing"),
    ("1", "I", "T", "US", "Inactive Provider", "Inactive Provider"),
    ("2", "A", None, "US", "TaxonomyCode is missing", "TaxonomyCode is missing"),
    ("3", "A", "T", "CA", "Invalid Country", "Invalid Country"),
    ("4", "I", None, "CA", "Inactive Provider", "Inactive Provider"),
    (None, "I", None, None, "ProviderID is missing", "ProviderID is missing"),
    ("5", None, "T", "US", "Inactive Provider", "Business rules passed"),
    ("6", "A", "T", None, "Invalid Country", "Business rules passed"),
    ("7", None, None, "US", "Inactive Provider", "TaxonomyCode is missing"),
    ("8", "A", "T", "US", "Business rules passed", "Business rules passed"),
]


@pytest.mark.parametrize("lenient", [False, True])
def test_rules(spark, lenient):
    df = spark.createDataFrame(
        [c[:4] + (c[5] if lenient else c[4],) for c in CASES],
        "ProviderID string, Status string, TaxonomyCode string, CountryCode string, want string",
    )
    args = (LENIENT_RULES,) if lenient else ()
    flagged = rule_status(rule_message(df, *args), *args)
    assert flagged.filter("BUSINESS_RULE_MESSAGE <> want").count() == 0
    passed = F.col("want") == "Business rules passed"
    assert flagged.filter((F.col("BUSINESS_RULE_STATUS") == "PASS") != passed).count() == 0
    assert flagged.count() == len(CASES)


def test_quality_warning_takes_first_missing(spark):
    df = spark.createDataFrame(
        [("p", "l", "i"), (None, None, None), ("p", None, None), ("p", "l", None)],
        "PhoneNumber string, LicenseNumber string, Identifier string",
    )
    assert [r[0] for r in quality_warning(df).select("DATA_QUALITY_WARNING").collect()] == [
        "No Data Quality Issues", "PhoneNumber Missing", "LicenseNumber Missing", "Identifier Missing",
    ]


def test_fill_full_name(spark):
    df = spark.createDataFrame(
        [("a", "b", None, "c"), ("a", "", "m", "c"), ("a", None, None, None), ("a", None, "", "c")],
        "FirstName string, FullName string, MiddleName string, LastName string",
    )
    assert [r.FullName for r in fill_full_name(df).collect()] == ["b", "a m c", "a", "a  c"]


SAME_ID = [
    ("1", "A", "2023-01-15"), ("1", "I", "2023-01-20"), ("1", "A", "2023-01-10"),
    ("1", None, "2024-01-01"), ("1", "A", "not a date"), ("1", "A", None),
]


@pytest.mark.parametrize("compat, best, worst", [
    (False, ("A", "2023-01-15"), None),
    (True, ("I", "2023-01-20"), (None, "2024-01-01")),
])
def test_survivorship(spark, compat, best, worst):
    df = spark.createDataFrame(SAME_ID, "ProviderID string, Status string, LastUpdated string")
    policy = Survivorship(compat=compat)
    ranked = survivor_rank(df, policy).orderBy("SURVIVOR_RANK").collect()
    assert [r.SURVIVOR_RANK for r in ranked] == [1, 2, 3, 4, 5, 6]
    assert (ranked[0].Status, ranked[0].LastUpdated) == best
    assert [r.SURVIVOR_STATUS for r in ranked] == ["SURVIVOR"] + ["DISCARDED"] * 5
    if worst:
        assert (ranked[-1].Status, ranked[-1].LastUpdated) == worst
    [only] = survivors(df, policy).collect()
    assert (only.Status, only.LastUpdated) == best


def test_undated_rows_rank_behind_dated_ones(spark):
    df = spark.createDataFrame(SAME_ID, "ProviderID string, Status string, LastUpdated string")
    ranked = survivor_rank(df).filter("Status = 'A'").orderBy("SURVIVOR_RANK").collect()
    assert [r.LastUpdated for r in ranked[:2]] == ["2023-01-15", "2023-01-10"]


def test_missing_phone_matches_nothing_unless_compat(spark):
    df = spark.createDataFrame(
        [("a", None, "10"), ("b", None, "10"), ("c", "1", "10"), ("d", "1", "10"), ("e", None, None),
         ("f", None, None)],
        "ProviderID string, PhoneNumber string, PostalCode string",
    )
    strict = {r.ProviderID: (r.FUZZY_MATCH_COUNT, r.FUZZY_MATCH_STATUS) for r in fuzzy_match(df).collect()}
    assert strict == {k: (1, "UNIQUE") for k in "abef"} | {k: (2, "REVIEW") for k in "cd"}
    loose = {r.ProviderID: (r.FUZZY_MATCH_KEY, r.FUZZY_MATCH_STATUS) for r in fuzzy_match(df, compat=True).collect()}
    assert loose["a"] == ("10", "REVIEW") and loose["e"] == ("", "REVIEW")


@pytest.mark.parametrize("compat", [False, True])
def test_golden_properties(spark, sf, compat):
    src = provider_src(spark, sf)
    policy = Survivorship(tie="SRC_KEY", compat=compat)
    gold = golden_record(src, policy)
    assert gold.columns == GOLD_COLUMNS
    assert gold.count() == src.select("ProviderID").distinct().count()
    assert gold.groupBy("ProviderID").count().filter("count > 1").count() == 0
    ranked = survivor_rank(src, policy)
    assert ranked.count() == src.count()
    assert ranked.filter("SURVIVOR_STATUS = 'SURVIVOR'").count() == gold.count()
    # flags computed on survivors equal flags computed on all rows first
    early = quality_warning(rule_status(fill_full_name(src), LENIENT_RULES if compat else rule_status.__defaults__[0]))
    assert rows(survivors(early, policy).select(*GOLD_COLUMNS)) == rows(gold)


def test_golden_prunes_and_limits_before_the_shuffle(spark, sf):
    gold = golden_record(provider_src(spark, sf), Survivorship(tie="SRC_KEY"))
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "o_totalprice" not in plan and "c_acctbal" not in plan
