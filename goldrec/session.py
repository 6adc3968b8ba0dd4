"""Session set-up and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_ROWS = 50_000  # rows of a task that builds or parses payloads


def build_session(app: str = "goldrec", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC and adaptive execution.

    The shuffle partition count is only an upper bound; adaptive execution merges small
    partitions, so a cluster should set it from its input size, not from its core count.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach, under ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = os.path.join(tempfile.gettempdir(), "goldrec")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(rows: DataFrame, count: int, by: Column | None = None) -> DataFrame:
    """Deal ``count`` rows, at most about TASK_ROWS to a task, before CPU-heavy work.

    To be put right before that work: a shuffle between would deal the rows anew, by their bytes, which
    say nothing of the work. Adaptive execution leaves an explicit number of partitions alone. Rows are
    dealt by a hash of their content, so that a task that is run again gets the same ones; or by ``by``,
    which an aggregation that groups by it needs no further shuffle for.
    """
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // TASK_ROWS))
    return rows.repartition(tasks, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]) if by is None else by)
