"""Hot groups must not change any result."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from goldrec.operators.matching import duplicate_flag, exact_match, fuzzy_match
from goldrec.operators.skew import restrict, with_group_rank
from goldrec.operators.survive import Survivorship, survivor_rank
from goldrec.plans.provider_view import provider_src
from tests.conftest import rows

@pytest.fixture(scope="module")
def skewed(spark, sf):
    """A third of all rows under one id, another part without id or phone."""
    src = provider_src(spark, sf)
    key = F.col("SRC_KEY")
    cached = src.withColumns({
        "ProviderID": F.when(key % 3 == 0, "hot").when(key % 3 == 1, F.col("ProviderID")),
        "PhoneNumber": F.when(key % 2 == 0, F.lit("410-1111")).when(key % 5 != 0, F.col("PhoneNumber")),
        "PostalCode": F.when(key % 4 == 0, F.lit("1")).otherwise(F.col("PostalCode")),
    }).persist()
    yield cached
    cached.unpersist()


def plain_count(df, keys, alone="false"):
    names = ", ".join(keys)
    df.createOrReplaceTempView("skewed_rows")
    sql = f"SELECT SRC_KEY, IF({alone}, 1, COUNT(*) OVER (PARTITION BY {names})) AS n FROM skewed_rows"
    return rows(df.sparkSession.sql(sql))


def test_group_sizes(skewed):
    assert rows(exact_match(skewed), "SRC_KEY", "EXACT_MATCH_COUNT") == plain_count(skewed, ["ProviderID"])


def test_fuzzy_sizes(skewed):
    missing = "PhoneNumber IS NULL OR PostalCode IS NULL"
    keyed = ["concat(PhoneNumber, '|', PostalCode)"]
    assert rows(fuzzy_match(skewed), "SRC_KEY", "FUZZY_MATCH_COUNT") == plain_count(skewed, keyed, missing)
    keyed = ["concat_ws('|', PhoneNumber, PostalCode)"]
    assert rows(fuzzy_match(skewed, compat=True), "SRC_KEY", "FUZZY_MATCH_COUNT") == plain_count(skewed, keyed)


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("tie", ["SRC_KEY", None])
@pytest.mark.parametrize("slice_rows", [1, 7, 40])
def test_ranks(skewed, slice_rows, tie, compat):
    policy = Survivorship(tie=tie, compat=compat)
    columns = ("SRC_KEY", "SURVIVOR_RANK", "SURVIVOR_STATUS")
    terms = policy.order(skewed)
    window = Window.partitionBy("ProviderID").orderBy(*[F.desc_nulls_last(t) for t in terms])
    plain = skewed.withColumns(terms).withColumn("SURVIVOR_RANK", F.row_number().over(window)).withColumn(
        "SURVIVOR_STATUS", F.when(F.col("SURVIVOR_RANK") == 1, "SURVIVOR").otherwise("DISCARDED"))
    assert rows(survivor_rank(skewed, policy, slice_rows), *columns) == rows(plain, *columns)


@pytest.mark.parametrize("slice_rows", [1, 7, 10**6])
def test_ranks_of_copies(skewed, slice_rows):
    """Whole-row copies: every copy keeps a rank of its own."""
    copies = skewed.select(
        "ProviderID", "Status", F.substring("LastUpdated", 1, 4).alias("LastUpdated")
    )
    ranked = survivor_rank(copies, Survivorship(), slice_rows)
    assert rows(ranked) == rows(survivor_rank(copies, Survivorship()))
    per_id = ranked.groupBy("ProviderID").agg(
        F.count("*").alias("n"), F.count_distinct("SURVIVOR_RANK").alias("d"), F.max("SURVIVOR_RANK").alias("m")
    )
    assert per_id.filter("n <> d OR n <> m").count() == 0


def test_ranks_with_a_lopsided_tie_break(spark):
    """One outlier far off doesn't leave nearly all rows in one slice."""
    ids = [*range(1000), 2**62]
    df = spark.createDataFrame([("x", "A", "2020-01-01", i) for i in ids], "ProviderID string, Status string, LastUpdated string, SRC_KEY long")
    ranked = survivor_rank(df, Survivorship(tie="SRC_KEY"), 20)
    assert [r.SRC_KEY for r in ranked.orderBy("SURVIVOR_RANK").collect()] == sorted(ids, reverse=True)
    assert ranked.agg(F.max("SURVIVOR_RANK")).first()[0] == len(ids)


def test_a_group_with_most_rows_is_cut(spark):
    """Nine of ten rows under one id: no slice has more than a small share of them."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).cast("string").alias("k"), (F.col("id") % 3).alias("lead"), F.col("id").alias("tie"))
    ranked = with_group_rank(df, "k", ["lead", "tie"], "place", unique=True, slice_rows=200)
    plan = ranked._jdf.queryExecution().analyzed().toString()
    assert "_slice" in plan
    got = ranked.filter("k = '-1'").orderBy("place").select("lead", "tie", "place").collect()
    assert [(r.lead, r.tie) for r in got] == sorted(((i % 3, i) for i in range(20_000) if i % 10), reverse=True)
    assert [r.place for r in got] == list(range(1, len(got) + 1))


@pytest.mark.parametrize("how", ["left_anti", "left_semi"])
def test_restrict(skewed, how):
    keys = skewed.filter("BATCH_ID < 'BATCH_1998'").select("BATCH_ID").distinct()
    keys = keys.union(keys.sparkSession.sql("SELECT CAST(NULL AS STRING)"))
    source = skewed.withColumn("BATCH_ID", F.when(F.col("SRC_KEY") % 50 != 0, F.col("BATCH_ID")))
    test = "BATCH_ID < 'BATCH_1998'" if how == "left_semi" else "NOT coalesce(BATCH_ID < 'BATCH_1998', false)"
    kept = restrict(source, keys, ["BATCH_ID"], how)
    assert kept.columns == source.columns
    assert rows(kept, *source.columns) == rows(source.filter(test), *source.columns)
    assert 0 < kept.count() < source.count()


def test_duplicate_count_is_the_exact_count(skewed):
    both = duplicate_flag(exact_match(skewed))
    assert both.filter("DUPLICATE_COUNT <> EXACT_MATCH_COUNT").count() == 0
    columns = ("SRC_KEY", "DUPLICATE_COUNT", "DUPLICATE_STATUS")
    assert rows(both, *columns) == rows(duplicate_flag(skewed), *columns)


def test_no_job_while_plans_are_built(spark, skewed):
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        exact_match(skewed), fuzzy_match(skewed), survivor_rank(skewed), restrict(skewed, skewed.select("BATCH_ID"), ["BATCH_ID"], "left_anti")
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setJobGroup("", "")
