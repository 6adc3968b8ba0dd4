"""Provider-shaped records over the order tables: one per order, NULLs put in by modulus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.schemas import SILVER_COLUMNS
from goldrec.session import spread


# Declared columns of the given tables: no job is spent on finding out the schema.
TABLES = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT, c_mktsegment STRING",
    "nation": "n_nationkey BIGINT, n_name STRING, n_regionkey BIGINT",
    "region": "r_regionkey BIGINT, r_name STRING",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def provider_count(spark: SparkSession, sf_dir: str) -> int:
    """Orders, counted in the footers: the view has at most as many rows."""
    return _read(spark, sf_dir, "orders").count()


def provider_src(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """18 attributes, 7 audit columns and the unique ``SRC_KEY``.

    ``heavy`` announces CPU-heavy work per row, for which the joined rows are dealt to tasks whose
    number grows with the orders; these are counted in the footers.
    """

    def read(name: str) -> DataFrame:
        return _read(spark, sf_dir, name)

    rows = (
        read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    if heavy:
        rows = spread(rows, provider_count(spark, sf_dir))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def missing_every(n: int, value: Column) -> Column:
        return F.when(key % n != 0, value)

    def text(c: Column) -> Column:
        return c.cast("string")

    date = F.col("o_orderdate").cast("date")
    year = text(F.year("o_orderdate"))
    return rows.select(
        missing_every(97, text(cust)).alias("ProviderID"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("FirstName"),
        F.when(key % 3 == 0, F.substring("c_mktsegment", 1, 1)).alias("MiddleName"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("LastName"),
        missing_every(11, F.col("c_name")).alias("FullName"),
        F.col("o_orderpriority").alias("Credential"),
        F.when(cust % 2 == 0, "F").otherwise("M").alias("Gender"),
        missing_every(89, F.when(F.col("o_orderstatus") == "P", "I").otherwise("A")).alias("Status"),
        text(date).alias("LastUpdated"),
        missing_every(83, F.concat(text(cust % 400), F.lit(" "), "n_name", F.lit(" ST"))).alias(
            "AddressLine1"
        ),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("State"),
        text(F.lit(10000) + F.col("c_nationkey") * 7).alias("PostalCode"),
        F.when(key % 53 == 0, "CA").otherwise("US").alias("CountryCode"),
        missing_every(7, F.concat(F.lit("410-"), text(key % 2000 + 1000))).alias("PhoneNumber"),
        missing_every(61, F.concat(F.lit("TX"), text(cust % 22))).alias("TaxonomyCode"),
        missing_every(4, F.concat(F.lit("LIC"), text(key))).alias("LicenseNumber"),
        missing_every(2, F.concat(F.lit("ID"), text(key))).alias("Identifier"),
        F.lit("NPPES").alias("SOURCE_SYSTEM"),
        F.lit("JISB").alias("PAYLOAD_FORMAT"),
        F.lit("MDM").alias("TARGET_SYSTEM"),
        F.col("o_orderdate").alias("LOAD_TIMESTAMP"),
        date.alias("LOAD_DATE"),
        F.concat(F.lit("processed_"), year, F.lit(".json")).alias("FILE_NAME"),
        F.concat(F.lit("BATCH_"), year).alias("BATCH_ID"),
        key.alias("SRC_KEY"),
    )


def silver_shape(df: DataFrame) -> DataFrame:
    """All 25 attributes and 7 audit columns; attributes the view lacks are NULL."""
    present = set(df.columns)
    return df.select(*[
        F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in SILVER_COLUMNS
    ])


