"""Landing changes to the keyed table: pending rows, the triggered upsert, its history."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from goldrec.operators.gates import new_batches
from goldrec.schemas import GOLD
from goldrec.sources.history import list_staged
from goldrec.streaming.ingest import LANDING, PACE, paced, start
from goldrec.streaming.keyed import KeyedTable

RUNS = T.StructType([
    T.StructField("COMMIT_ID", T.LongType()),
    T.StructField("STATE", T.StringType()),
    T.StructField("SOURCE_ROWS", T.LongType()),
    T.StructField("STARTED_AT", T.TimestampType()),
    T.StructField("FINISHED_AT", T.TimestampType()),
    T.StructField("ERROR_MESSAGE", T.StringType()),
])


def changes(spark: SparkSession, landing: str, pace: int = PACE) -> DataFrame:
    """Rows added to landing since the consuming query's checkpoint, as a stream."""
    rows = paced(spark.readStream.schema(LANDING), pace).parquet(landing)
    return rows.filter("NOT REJECTED").select(*GOLD.names)


def pending(landing: DataFrame, consumed: DataFrame | None) -> DataFrame:
    """Landing rows of batches that were not consumed yet."""
    return new_batches(landing, consumed)


def pending_counts(landing: DataFrame, consumed: DataFrame | None) -> DataFrame:
    return (
        pending(landing, consumed)
        .groupBy("BATCH_ID")
        .agg(F.count(F.lit(1)).alias("PENDING_RECORDS"))
    )


def has_data(landing: DataFrame, consumed: DataFrame | None) -> DataFrame:
    """One row telling whether anything is pending.

    Only batch ids are read, and they are made distinct before they are compared.
    """
    batches = landing.select("BATCH_ID").filter("BATCH_ID IS NOT NULL").distinct()
    if consumed is not None:
        batches = batches.join(consumed.select("BATCH_ID").distinct(), "BATCH_ID", "left_anti")
    return batches.agg((F.count(F.lit(1)) > 0).alias("HAS_DATA"))


def has_pending(spark: SparkSession, landing: str, checkpoint: str) -> bool:
    """Whether landing has a file that the consuming query hasn't finished.

    The listing is compared with the files of finished micro-batches in the query's checkpoint;
    no data file is read.
    """
    listed = list_staged(spark, landing, "*.parquet").select("FILE_PATH")
    try:
        last = spark.read.text(f"{checkpoint}/commits").agg(F.max(F.col("_metadata.file_name").cast("long"))).first()[0]
        log = spark.read.text(f"{checkpoint}/sources/0").filter("value LIKE '{%'")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return not listed.isEmpty()
        raise
    entry = F.from_json("value", "path string, batchId long")
    taken = log.select(entry.alias("e")).filter(F.col("e.batchId") <= F.lit(-1 if last is None else last))
    # the log has escaped URIs, the listing paths as the file system names them
    named = F.regexp_replace(F.url_decode(F.replace("e.path", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    return not listed.join(taken.select(named.alias("FILE_PATH")), "FILE_PATH", "left_anti").isEmpty()


def triggered_upsert(spark: SparkSession, landing: str, table: KeyedTable, checkpoint: str, runs: str, pace: int = PACE) -> bool:
    """Run the upsert if anything is pending; whether it ran."""
    if not has_pending(spark, landing, checkpoint):
        return False
    run_upsert(spark, landing, table, checkpoint, runs, pace=pace)
    return True


def run_upsert(
    spark: SparkSession,
    landing: str,
    table: KeyedTable,
    checkpoint: str,
    runs: str,
    every: str | None = None,
    pace: int = PACE,
) -> StreamingQuery:
    """Merge pending landing rows into the table; without pending rows nothing runs.

    A micro-batch that Spark repeats after a failure writes the same commit again. A table belongs
    to one checkpoint, since the commits are numbered by it; 0 is left to a first load.
    """

    def merge(rows: DataFrame, epoch: int) -> None:
        started = datetime.now(timezone.utc)
        state, taken, error = "SUCCEEDED", 0, None
        try:
            taken = table.merge(rows, epoch + 1)
        except Exception as e:
            state, error = "FAILED", str(e)
            raise
        finally:
            entry = (epoch + 1, state, taken, started, datetime.now(timezone.utc), error)
            log = spark.createDataFrame([entry], RUNS)
            log.coalesce(1).write.mode("append").parquet(runs)

    return start(changes(spark, landing, pace).writeStream.foreachBatch(merge), checkpoint, every)


def run_history(spark: SparkSession, runs: str) -> DataFrame:
    """All runs, newest first."""
    return spark.read.schema(RUNS).parquet(runs).orderBy(F.desc("STARTED_AT"))
