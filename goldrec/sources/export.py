"""Batch exports to Parquet and their log."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldrec.operators.gates import gate_export
from goldrec.schemas import EXPORT_LOG


@dataclass(frozen=True)
class ExportResult:
    batch_id: str
    path: str
    rows: int
    status: str
    error: str | None = None
    skipped: bool = False


def _run_name() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def log_rows(spark: SparkSession, results: list[ExportResult]) -> DataFrame:
    """One log row per attempt, with the schema given so that an empty error is no problem."""
    now = datetime.now(timezone.utc)
    rows = [
        (str(uuid.uuid4()), r.batch_id, now, r.path, r.rows, r.status, r.error)
        for r in results
        if not r.skipped
    ]
    return spark.createDataFrame(rows, EXPORT_LOG)


def log_export(attempts: DataFrame, log_path: str, mode: str = "append") -> None:
    """Add the attempts to the log."""
    attempts.coalesce(1).write.mode(mode).parquet(log_path)


def export_batch(
    gold: DataFrame,
    batch_id: str,
    directory: str,
    log: DataFrame | None = None,
    files: int | None = None,
    rows_per_file: int = 5_000_000,
) -> ExportResult:
    """Write one batch under a new name; a batch exported before is skipped.

    A batch without rows writes no file and still counts as a success. The write is spread
    over the tasks that hold the rows; ``files`` merges small batches into that many files.
    """
    if log is not None and not log.filter(
        (F.col("BATCH_ID") == batch_id) & (F.col("STATUS") == "SUCCESS")
    ).isEmpty():
        return ExportResult(batch_id, "N/A", 0, "SUCCESS", skipped=True)
    rows = gold.filter(F.col("BATCH_ID") == batch_id)
    if rows.isEmpty():
        return ExportResult(batch_id, "N/A", 0, "SUCCESS")
    path = f"{directory}/provider_gold_{_run_name()}.parquet"
    if files:
        rows = rows.coalesce(files)
    written = Observation()
    try:
        rows.observe(written, F.count(F.lit(1)).alias("n")).write.mode("error").option(
            "maxRecordsPerFile", rows_per_file
        ).parquet(path)
    except Exception as e:  # whatever it is, the attempt is logged as failed
        return ExportResult(batch_id, path, rows.count(), "FAILED", str(e))
    return ExportResult(batch_id, path, written.get["n"], "SUCCESS")


def _folder(file_path: Column) -> Column:
    """A file's folder as the file system names it: the path in file metadata is an escaped URI."""
    return F.url_decode(F.replace(F.regexp_replace(file_path, "/[^/]*$", ""), F.lit("+"), F.lit("%2B")))


def export_pending(
    gold: DataFrame,
    directory: str,
    log: DataFrame | None = None,
    run: str | None = None,
    rows_per_file: int = 5_000_000,
) -> DataFrame:
    """Write every batch without a successful export in one job; gives the rows for the log.

    Rows are grouped by batch for the write; adaptive execution splits a large batch over
    several tasks and files. Each batch lands in its own folder and yields one log row, counted
    in what was written. A ``run`` that is named writes the same folder when it is repeated.
    """
    spark = gold.sparkSession
    pending = gate_export(gold, log)
    path = f"{directory}/provider_gold_{run or _run_name()}"
    try:
        (
            pending.withColumn("batch", F.col("BATCH_ID"))
            .hint("rebalance", "batch")
            .write.mode("overwrite")
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy("batch")
            .parquet(path)
        )
        status, error = "SUCCESS", None
        written = spark.read.schema("BATCH_ID STRING, batch STRING").parquet(path)
        found = written.select("BATCH_ID", _folder(F.col("_metadata.file_path")).alias("S3_PATH"))
    except Exception as e:  # whatever it is, the attempts are logged as failed
        status, error = "FAILED", str(e)
        found = pending.select("BATCH_ID", F.lit(path).alias("S3_PATH"))
    counts = found.groupBy("BATCH_ID").agg(F.min("S3_PATH").alias("S3_PATH"), F.count(F.lit(1)).alias("ROW_COUNT"))
    return counts.select(
        F.expr("uuid()").alias("EXPORT_ID"), "BATCH_ID", F.lit(datetime.now(timezone.utc)).alias("EXPORT_TIMESTAMP"),
        "S3_PATH", "ROW_COUNT", F.lit(status).alias("STATUS"), F.lit(error).cast("string").alias("ERROR_MESSAGE"))
