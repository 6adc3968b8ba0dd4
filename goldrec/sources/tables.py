"""Parquet tables: creation, append, and loading files by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Create the table if it is absent; an existing one and its rows stay as they are."""
    namespace, _, _ = name.rpartition(".")
    if namespace:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{where}")
    return spark.table(name)


def append(df: DataFrame, table: str) -> None:
    """Append by column name; rows already in the table are not touched."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.mode("append").insertInto(table)


def initial_load(landing: DataFrame, gold_table: str) -> None:
    """One-off copy of all landing rows, without a key check."""
    append(landing, gold_table)


def conform(df: DataFrame, schema: T.StructType, carry: tuple[str, ...] = ()) -> DataFrame:
    """Match columns by name regardless of case and cast them to the wanted types.

    A column that is missing becomes NULL, one that is unknown is dropped. FAILED_COLUMNS
    names the columns whose value does not cast; ORIGINAL then keeps the row as JSON text.
    ``carry`` names columns that are not part of the row and pass through.
    """
    actual: dict[str, str] = {}
    for c in df.columns:
        if c not in carry:
            actual.setdefault(c.lower(), c)
    casts, failures = [], []
    for f in schema.fields:
        source = actual.get(f.name.lower())
        if source is None:
            casts.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f"`{source}`")
        value = raw.try_cast(f.dataType)
        casts.append(value.alias(f.name))
        failures.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f.name)))
    failed = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    original = F.to_json(F.struct(*[F.col(f"`{c}`") for c in actual.values()]))
    return df.select(
        *casts,
        failed.alias("FAILED_COLUMNS"),
        F.when(F.size(failed) > 0, original).alias("ORIGINAL"),
        *carry,
    )
