"""Dimension, marts, data tests, reconciliation and dashboard figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.operators.rules import QUALITY_OK
from goldrec.plans.reports import group_count, layer_counts
from goldrec.schemas import GOLD_COLUMNS
from goldrec.streaming.keyed import KeyedTable, folders

# The distinct-count measure of a mart and the column it counts.
MEASURES = {
    "TOTAL_STATES": "State",
    "TOTAL_CITIES": "City",
    "TOTAL_SPECIALIZATIONS": "TaxonomyCode",
}


def dimension(gold: DataFrame) -> DataFrame:
    return gold.select(*GOLD_COLUMNS)


@dataclass(frozen=True)
class Mart:
    """Rows, conditional tallies (SQL conditions) and distinct counts per value of ``by``.

    Rows are first counted per combination of the group and the counted columns (cells). That
    combines before the shuffle and leaves few rows for the distinct counts, which would
    otherwise multiply every input row by the number of distinct columns.
    """

    by: str
    distinct: tuple[str, ...]
    tallies: Mapping[str, str] = field(default_factory=dict)
    newest_first: bool = False

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys([self.by, *[MEASURES[m] for m in self.distinct]]))

    def cells(self, rows: DataFrame, sign: Column | None = None) -> DataFrame:
        """Counts per combination; ``sign`` counts a row as 1 or takes it back as -1."""
        one = F.lit(1) if sign is None else sign
        return rows.groupBy(*self.columns).agg(
            F.sum(one).cast("long").alias("_rows"),
            *[F.sum(F.when(F.expr(condition), one).otherwise(0)).cast("long").alias(name) for name, condition in self.tallies.items()],
        )

    def add(self, cells: DataFrame) -> DataFrame:
        """Cells that stand for the same combination made one; what was taken back in full goes."""
        sums = [F.sum(c).alias(c) for c in ("_rows", *self.tallies)]
        return cells.groupBy(*self.columns).agg(*sums).filter("_rows > 0")

    def roll_up(self, cells: DataFrame) -> DataFrame:
        rolled = cells.groupBy(self.by).agg(
            F.sum("_rows").alias("TOTAL_PROVIDERS"),
            *[F.sum(name).alias(name) for name in self.tallies],
            *[F.count_distinct(F.col(MEASURES[m])).alias(m) for m in self.distinct],
        )
        order = F.desc_nulls_last(self.by) if self.newest_first else F.desc("TOTAL_PROVIDERS")
        return rolled.orderBy(order, F.asc_nulls_last(self.by))

    def __call__(self, dim: DataFrame) -> DataFrame:
        return self.roll_up(self.cells(dim))


def _state(active: str, inactive: str, male: str, female: str) -> Mart:
    return Mart("State", ("TOTAL_SPECIALIZATIONS",), {
        "ACTIVE_PROVIDERS": f"Status = '{active}'",
        "INACTIVE_PROVIDERS": f"Status = '{inactive}'",
        "MALE_PROVIDERS": f"Gender = '{male}'",
        "FEMALE_PROVIDERS": f"Gender = '{female}'",
    })


def _summary(warned: str) -> Mart:
    return Mart("LOAD_DATE", ("TOTAL_STATES", "TOTAL_CITIES", "TOTAL_SPECIALIZATIONS"), {
        "BUSINESS_RULE_PASS": "BUSINESS_RULE_STATUS = 'PASS'",
        "BUSINESS_RULE_FAIL": "BUSINESS_RULE_STATUS = 'FAIL'",
        "DATA_QUALITY_WARNINGS": warned,
    }, newest_first=True)


def mart_state(dim: DataFrame, compat: bool = False) -> DataFrame:
    """Per state. ``compat`` compares with spelled-out words the data never holds."""
    return (_state("Active", "Inactive", "Male", "Female") if compat else MARTS["mart_provider_state"])(dim)


def mart_summary(dim: DataFrame, compat: bool = False) -> DataFrame:
    """Per load date, newest first. ``compat`` counts a warning text that never occurs."""
    return (_summary("DATA_QUALITY_WARNING = 'YES'") if compat else MARTS["mart_provider_summary"])(dim)


MARTS = {
    "mart_provider_state": _state("A", "I", "M", "F"),
    "mart_provider_summary": _summary(f"DATA_QUALITY_WARNING <> '{QUALITY_OK}'"),
    "mart_provider_gender": Mart("Gender", ("TOTAL_STATES", "TOTAL_SPECIALIZATIONS")),
    "mart_provider_taxonomy": Mart("TaxonomyCode", ("TOTAL_STATES", "TOTAL_CITIES")),
    "mart_provider_business_rules": Mart("BUSINESS_RULE_STATUS", ("TOTAL_STATES", "TOTAL_SPECIALIZATIONS")),
    "mart_provider_data_quality": Mart("DATA_QUALITY_WARNING", ("TOTAL_STATES", "TOTAL_SPECIALIZATIONS")),
}
mart_gender, mart_taxonomy, mart_rules, mart_quality = (
    MARTS[f"mart_provider_{name}"] for name in ("gender", "taxonomy", "business_rules", "data_quality"))


class IncrementalMarts:
    """Marts kept as cells, which a commit of the keyed table adds to and takes back from.

    A commit costs its own rows, those that they replace, and the cells. The cells after each commit are a
    folder of their own, made from those after the one before, so doing a commit again changes nothing.
    """

    def __init__(self, table: KeyedTable, root: str):
        self.table, self.root, self.spark = table, root.rstrip("/"), table.spark

    def _done(self, name: str) -> list[int]:
        return sorted(int(f.rsplit("=", 1)[1]) for f in folders(self.spark, f"{self.root}/{name}/AT=*"))

    def cells(self, name: str, at: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/AT={at}")

    def refresh(self) -> list[int]:
        """Bring every mart up to the table's last commit; the commits that were new to one of them."""
        done = {name: self._done(name) for name in MARTS}
        taken = []
        for commit in self.table.commits():
            behind = [name for name in MARTS if not done[name] or done[name][-1] < commit]
            if not behind:
                continue
            signed = self.table.signed_changes(commit).persist()
            for name in behind:
                cells = MARTS[name].cells(signed, F.col("SIGN"))
                if done[name]:
                    cells = self.cells(name, done[name][-1]).unionByName(cells)
                MARTS[name].add(cells).write.mode("overwrite").parquet(f"{self.root}/{name}/AT={commit}")
                done[name].append(commit)
            signed.unpersist()
            taken.append(commit)
        return taken

    def read(self, name: str) -> DataFrame:
        done = self._done(name)
        if not done:
            return MARTS[name](self.table.read())
        return MARTS[name].roll_up(self.cells(name, done[-1]))


def materialise(df: DataFrame, name: str, kind: str = "table", path: str | None = None) -> DataFrame:
    """Publish a model: staging as a view, dimension and marts as tables."""
    spark: SparkSession = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        raise ValueError(f"unknown materialisation: {kind}")
    return spark.table(name)


def build_models(gold: DataFrame, root: str | None = None, prefix: str = "") -> dict[str, DataFrame]:
    """Staging view, dimension and the six marts, each built from the one before."""

    def path(name: str) -> str | None:
        return f"{root}/{name}" if root else None

    staging = materialise(dimension(gold), f"{prefix}stg_provider", "view")
    dim_name = f"{prefix}dim_provider"
    models = {"dim_provider": materialise(staging, dim_name, path=path(dim_name))}
    for name, build in MARTS.items():
        models[name] = materialise(
            build(models["dim_provider"]), f"{prefix}{name}", path=path(f"{prefix}{name}")
        )
    return models


# Data tests: each returns the failing values or rows -----------------------------------


def test_unique(df: DataFrame, column: str) -> DataFrame:
    present = df.filter(F.col(column).isNotNull())
    return present.groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def test_accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted ones; NULL passes."""
    outside = df.filter(~F.col(column).isin(*accepted))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


for _test in (test_unique, test_not_null, test_accepted_values):
    _test.__test__ = False  # operators, not test cases


# Reconciliation ------------------------------------------------------------------------


def reconcile_counts(gold: DataFrame, dim: DataFrame) -> DataFrame:
    """Both row counts on one row."""
    rows = F.count(F.lit(1))
    return gold.agg(rows.alias("GOLD_COUNT")).withColumn(
        "DIM_COUNT", dim.agg(rows.alias("n")).scalar()
    )


def _cells(dim: DataFrame, *columns: str) -> DataFrame:
    return dim.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))


def cardinality(dim: DataFrame) -> DataFrame:
    cells = _cells(dim, *MEASURES.values())
    return cells.agg(*[F.count_distinct(F.col(c)).alias(m) for m, c in MEASURES.items()])


def dim_rule_summary(dim: DataFrame) -> DataFrame:
    """Rows per rule status and per quality warning, one list."""
    parts = []
    for column in ("BUSINESS_RULE_STATUS", "DATA_QUALITY_WARNING"):
        counted = group_count(dim, column, measure="TOTAL_RECORDS")
        parts.append(counted.select(F.lit(column).alias("ATTRIBUTE"), F.col(column).alias("VALUE"), "TOTAL_RECORDS"))
    return parts[0].unionByName(parts[1])


# The dimension columns whose values are listed.
LISTED = ("State", "City", "Gender", "Status", "CountryCode", "TaxonomyCode")


def dim_distincts(dim: DataFrame) -> DataFrame:
    """Distinct values of the listed columns, one list."""
    cells = _cells(dim, *LISTED)
    pairs = [F.struct(F.lit(c).alias("ATTRIBUTE"), F.col(c).alias("VALUE")) for c in LISTED]
    return cells.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*").distinct()


def mart_counts(dim: DataFrame) -> DataFrame:
    return layer_counts({name: build(dim) for name, build in MARTS.items()})


# Dashboard figures ---------------------------------------------------------------------


def slice_dimension(
    dim: DataFrame, states: Sequence[str] | None = None, genders: Sequence[str] | None = None
) -> DataFrame:
    """The dimension restricted by the state and gender slicers; None means all."""
    if states is not None:
        dim = dim.filter(F.col("State").isin(*states))
    if genders is not None:
        dim = dim.filter(F.col("Gender").isin(*genders))
    return dim


def kpi_row(dim: DataFrame, compat: bool = False) -> DataFrame:
    """Headline figures. ``compat`` adds up every rule status in the pass figure."""
    cells = dim.groupBy(*MEASURES.values()).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("BUSINESS_RULE_STATUS") == "PASS").alias("_pass"),
    )
    passed = "_rows" if compat else "_pass"
    return cells.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("TOTAL_PROVIDERS"),
        *[F.count_distinct(F.col(c)).alias(m) for m, c in MEASURES.items()],
        F.coalesce(F.sum(passed), F.lit(0)).alias("BUSINESS_RULE_PASS"),
    )


def cross_filter(mart_rows: DataFrame, sliced: DataFrame, key: str) -> DataFrame:
    """Mart rows whose key still occurs in the sliced dimension."""
    return mart_rows.join(sliced.select(key).distinct(), key, "left_semi")


def share(dim: DataFrame, by: str) -> DataFrame:
    """Count per value and its percentage of all rows."""
    rows = F.count(F.lit(1))
    percent = F.try_divide(F.col("TOTAL_PROVIDERS") * 100.0, dim.agg(rows.alias("n")).scalar())
    return (
        dim.groupBy(by)
        .agg(rows.alias("TOTAL_PROVIDERS"))
        .withColumn("PERCENT", F.round(percent, 6))
    )


def top_taxonomies(dim: DataFrame, n: int = 10) -> DataFrame:
    return group_count(dim, "TaxonomyCode").limit(n)
