"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.session import scratch_dir

BATCH_ROWS = 1_000
_SHIPPED: set[str] = set()
LOWEST = -(2**63 - 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Ship this package to the executors, once, and send at most BATCH_ROWS rows to Python at once.

    Texts are long rows: the default of ten thousand takes a task hundreds of megabytes on either
    side.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp()  # the driver's own, until it ends; Spark hands the archive on
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/goldrec", "zip", root, "goldrec"))


def written(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: a lost executor repeats nothing before."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A table from a few driver-side rows (bounded by parameters, never by the data)."""
    packed = F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(packed).alias("r")).select("r.*")


def first_at_least(value: Column, points: Sequence[int]) -> Column:
    """Index of the first of the ascending ``points`` that is >= value, len(points) if none is.

    A binary search over one array literal: the number of steps is fixed by len(points).
    """
    steps = max(1, len(points).bit_length())
    array = F.lit(list(points)).cast("array<bigint>")

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        below = F.coalesce(F.get(array, middle) < value, F.lit(False))
        open_ = state["lo"] < state["hi"]
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(state["lo"]).cast("int").alias("lo"),
            F.when(open_ & ~below, middle).otherwise(state["hi"]).cast("int").alias("hi"),
        )

    begin = F.struct(F.lit(0).cast("int").alias("lo"), F.lit(len(points)).cast("int").alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, halve)["lo"]
