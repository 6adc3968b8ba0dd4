"""Decide per batch what is new, what may be written and what was already exported."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.operators.skew import restrict


def batch_list(df: DataFrame) -> DataFrame:
    return df.select("BATCH_ID").distinct()


def unbatched(df: DataFrame) -> DataFrame:
    """Rows without a batch id: no gate can decide on them, so they are set aside."""
    return df.filter(F.col("BATCH_ID").isNull())


def new_batches(src: DataFrame, done: DataFrame | None) -> DataFrame:
    """Rows of batches that the target does not hold yet; no target means all batches.

    The new batches are found from the batch columns alone and then selected by name, so
    a source partitioned by batch is read for these batches only.
    """
    batched = src.filter(F.col("BATCH_ID").isNotNull())
    if done is None:
        return batched
    wanted = batch_list(batched).join(batch_list(done), "BATCH_ID", "left_anti")
    return restrict(batched, wanted, ["BATCH_ID"], "left_semi")


def batch_presence(spark: SparkSession, table: str, batch_id: str) -> int:
    """Rows a table holds for a batch; a table that does not exist holds none."""
    if not spark.catalog.tableExists(table):
        return 0
    return spark.table(table).filter(F.col("BATCH_ID") == batch_id).count()


def _held_ids(gold: DataFrame, distinct: bool) -> DataFrame:
    ids = gold.select("ProviderID").filter("ProviderID IS NOT NULL")
    return ids if distinct else ids.distinct()


def known_providers(candidate: DataFrame, gold: DataFrame, distinct: bool = False) -> DataFrame:
    """Per candidate batch: its distinct ids, how many gold already holds, the verdict.

    Ids are made distinct per batch before they are joined, so a hot id is one row. ``distinct``
    says that ``gold`` is a table of ids that holds each once, so that it isn't shuffled for that.
    """
    ids = candidate.select("BATCH_ID", "ProviderID").distinct()
    held = _held_ids(gold, distinct).withColumnRenamed("ProviderID", "_held")
    return (
        ids.join(held, F.col("ProviderID") == F.col("_held"), "left")
        .groupBy("BATCH_ID")
        .agg(F.count("ProviderID").alias("PROVIDERS"), F.count("_held").alias("KNOWN_PROVIDERS"))
        .withColumn("BLOCKED", F.col("KNOWN_PROVIDERS") > 0)
    )


def gate_providers(
    candidate: DataFrame,
    gold: DataFrame | None,
    mode: str = "skip_batch",
    distinct: bool = False,
) -> DataFrame:
    """Rows that may be appended to gold, out of golden records: one row per id.

    ``skip_batch`` holds back every batch that has an id gold knows; ``anti`` appends the
    unseen ids of every batch; ``upsert`` appends all rows, for a keyed table to take the newest
    of each id. NULL ids are never known. ``distinct`` as for :func:`known_providers`.
    """
    if mode not in ("skip_batch", "anti", "upsert"):
        raise ValueError(f"unknown gate mode: {mode}")
    if gold is None or mode == "upsert":
        return candidate
    if mode == "anti":
        held = _held_ids(gold, distinct)
        # NULL ids cannot match, so they stay out of the shuffle.
        unseen = candidate.filter("ProviderID IS NOT NULL").join(held, "ProviderID", "left_anti")
        missing = candidate.filter("ProviderID IS NULL")
        return unseen.select(*candidate.columns).unionByName(missing)
    blocked = known_providers(candidate, gold, distinct).filter("BLOCKED").select("BATCH_ID")
    return restrict(candidate, blocked, ["BATCH_ID"], "left_anti")


def gate_export(gold: DataFrame, log: DataFrame | None) -> DataFrame:
    """Rows of batches without a successful export."""
    return new_batches(gold, None if log is None else log.filter("STATUS = 'SUCCESS'"))


class BatchMismatch(ValueError):
    """The frame to export is empty or lacks the batch to export."""


def check_batch(df: DataFrame, batch_id: str) -> int:
    """Rows in the frame; raises if there are none or none of the batch."""
    total, of_batch = df.agg(
        F.count(F.lit(1)), F.count_if(F.col("BATCH_ID") == batch_id)
    ).first()
    if total == 0:
        raise BatchMismatch("no records to export")
    if of_batch == 0:
        raise BatchMismatch(f"batch {batch_id} is not among the records to export")
    return total
