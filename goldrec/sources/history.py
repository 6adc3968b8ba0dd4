"""Which files are staged and which of them were loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_staged(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files present with size and time; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.select(
        F.col("path").alias("FILE_PATH"),
        F.col("length").alias("BYTES"),
        F.col("modificationTime").alias("MODIFIED_AT"),
    )


def load_history(staged: DataFrame, audit: DataFrame, days: int = 7) -> DataFrame:
    """Every staged file with its load time and rows; NULL there means not loaded yet.

    ``audit`` holds one row per loaded file and micro-batch: FILE_PATH, ROWS, LOADED_AT.
    Loads before the last ``days`` days are left out.
    """
    since = F.current_timestamp() - F.make_dt_interval(F.lit(days))
    loads = audit.groupBy("FILE_PATH").agg(
        F.sum("ROWS").alias("ROWS"), F.max("LOADED_AT").alias("LOADED_AT")
    )
    joined = staged.join(loads, "FILE_PATH", "left")
    return joined.filter(F.col("LOADED_AT").isNull() | (F.col("LOADED_AT") >= since))
