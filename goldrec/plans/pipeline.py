"""The layered job: bronze to silver to gold, exports, landing, keyed table, models.

Every step is a stream that drains what is new and stops. Its checkpoint is the ledger of what has
been taken, file by file, so a file that arrives late for a batch goes on like any other. A step
writes the folder of its micro-batch (``EPOCH``) over, so a run that died anywhere can be repeated
and gives the same tables. Steps run one after another, one run at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.operators.gates import gate_providers, known_providers, unbatched
from goldrec.operators.payload import clean_strings, extract_fields, fieldless, parse_payload
from goldrec.operators.survive import Survivorship, golden_record
from goldrec.plans.marts import MARTS, IncrementalMarts, dimension
from goldrec.schemas import BRONZE, EXPORT_LOG, GOLD, SILVER
from goldrec.sources.export import export_pending, log_export
from goldrec.streaming.cdc import triggered_upsert
from goldrec.streaming.ingest import PACE, ingest_files, load_by_name, paced, start
from goldrec.streaming.keyed import KeyedTable

EPOCH = T.StructField("EPOCH", T.LongType())
VERDICTS = T.StructType([
    T.StructField("BATCH_ID", T.StringType()),
    T.StructField("PROVIDERS", T.LongType()),
    T.StructField("KNOWN_PROVIDERS", T.LongType()),
    T.StructField("WRITTEN", T.LongType()),
    T.StructField("VERDICT", T.StringType()),
])


@dataclass(frozen=True)
class Layout:
    """Folders of one installation, all below one root that every executor reaches."""

    root: str
    survivorship: Survivorship = field(default_factory=Survivorship)
    gate: str = "skip_batch"
    pace: int = PACE

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A layer's rows, or None before its first write."""
    try:
        return spark.read.schema(T.StructType([*schema.fields, EPOCH])).parquet(path).select(*schema.names)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_epoch(df: DataFrame, path: str, epoch: int, rebalance: bool = True) -> None:
    """A micro-batch's rows in a folder of its own; doing it again replaces them.

    Rows that come evenly from a shuffle of their own need no ``rebalance``.
    """
    rows = df.hint("rebalance") if rebalance else df
    rows.write.mode("overwrite").parquet(f"{path}/EPOCH={epoch}")


def each_epoch(
    spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, step: Callable[[DataFrame, int], None],
    pace: int | None = None,
) -> None:
    """Run ``step`` on what a layer has gained since the checkpoint, at most ``pace`` bytes at once or all of it."""
    if read_layer(spark, path, schema) is None:
        return
    reader = paced(spark.readStream.schema(T.StructType([*schema.fields, EPOCH])), pace)
    rows = reader.parquet(path).select(*schema.names)
    start(rows.writeStream.foreachBatch(step), checkpoint)


def refine_silver(spark: SparkSession, layout: Layout) -> None:
    """Standardise the bronze rows that silver hasn't taken.

    Rows without a batch and payloads without fields cannot go on; both are kept apart, in the
    same step, so neither is lost or looked at again.
    """

    def step(bronze: DataFrame, epoch: int) -> None:
        write_epoch(unbatched(bronze), layout.at("unbatched"), epoch)
        parsed = parse_payload(bronze.filter("BATCH_ID IS NOT NULL"))
        write_epoch(fieldless(parsed).select(*BRONZE.names), layout.at("rejects"), epoch)
        # dealt by digest to remove copies, so already even
        write_epoch(clean_strings(extract_fields(parsed)), layout.at("silver"), epoch, rebalance=False)

    each_epoch(spark, layout.at("bronze"), BRONZE, layout.at("checkpoints/silver"), step, layout.pace)


def known_ids(spark: SparkSession, layout: Layout) -> KeyedTable:
    """The ids that gold holds, each once, bucketed: the gate brings a batch's ids to them and shuffles none of them."""
    ids = T.StructType([T.StructField("ProviderID", T.StringType())])
    return KeyedTable(spark, layout.at("known"), "ProviderID", ids)


def decide(
    rows: DataFrame, held: DataFrame | None, layout: Layout, distinct: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Golden records of the rows that may be written, and the verdict on each batch.

    The gate comes first: a blocked batch takes no part in survivorship, so none of its rows can
    beat one of a batch that is written. Verdicts: written, blocked, lost (no row survived).
    """
    if held is None:
        held = rows.select("ProviderID").filter("false")
    known = known_providers(rows, held, distinct)
    best = golden_record(gate_providers(rows, held, layout.gate, distinct), layout.survivorship)
    best = best.withColumn("LOAD_TIMESTAMP", F.col("LOAD_TIMESTAMP").cast("timestamp_ntz"))
    written = best.groupBy("BATCH_ID").agg(F.count(F.lit(1)).alias("WRITTEN"))
    blocked = F.col("BLOCKED") & F.lit(layout.gate == "skip_batch")
    verdict = F.when(blocked, "blocked").when(F.col("WRITTEN") > 0, "written").otherwise("lost")
    ledger = known.join(written, "BATCH_ID", "left").select(
        "BATCH_ID", "PROVIDERS", "KNOWN_PROVIDERS", F.coalesce("WRITTEN", F.lit(0).cast("long")).alias("WRITTEN"),
        verdict.alias("VERDICT"))
    return best, ledger


def refine_gold(spark: SparkSession, layout: Layout) -> None:
    """Golden records of the silver rows that gold hasn't taken, behind the provider gate.

    What is compared are the ids as of the epochs before, so a repeated epoch decides the same. All that
    is new is taken at once: a batch in two parts would find its own first part in gold.
    """

    def step(rows: DataFrame, epoch: int) -> None:
        known = known_ids(spark, layout)
        if not known.commits() and (gold := read_layer(spark, layout.at("gold"), GOLD)) is not None and epoch > 0:
            known.merge(gold.select("ProviderID").filter("ProviderID IS NOT NULL"), -1, newest="ProviderID")
        best, ledger = decide(rows, known.read(until=epoch - 1), layout, distinct=True)
        write_epoch(best, layout.at("gold"), epoch)
        write_epoch(ledger, layout.at("verdicts"), epoch)
        taken = spark.read.schema(GOLD).parquet(f"{layout.at('gold')}/EPOCH={epoch}").filter("ProviderID IS NOT NULL")
        known.merge(taken.select("ProviderID"), epoch, newest="ProviderID")
        known.settle()

    each_epoch(spark, layout.at("silver"), SILVER, layout.at("checkpoints/gold"), step)


def publish(spark: SparkSession, layout: Layout) -> None:
    """Export the gold rows that haven't been, and log the attempts.

    The folder is named by the epoch: after a crash the same rows are exported to it again, and
    landing, which runs later, sees only the last attempt. A failed attempt is logged and raised.
    """

    def step(rows: DataFrame, epoch: int) -> None:
        attempts = export_pending(rows, layout.at("exports"), run=f"{epoch:012d}").persist()
        try:
            log_export(attempts, f"{layout.at('export_log')}/EPOCH={epoch}", mode="overwrite")
            failed = attempts.filter("STATUS <> 'SUCCESS'").first()
        finally:
            attempts.unpersist()
        if failed:
            raise RuntimeError(failed["ERROR_MESSAGE"])

    each_epoch(spark, layout.at("gold"), GOLD, layout.at("checkpoints/exports"), step, layout.pace)


def keyed_table(spark: SparkSession, layout: Layout) -> KeyedTable:
    return KeyedTable(spark, layout.at("master"))


def load_master(spark: SparkSession, layout: Layout) -> None:
    """Exports to landing, landing changes into the keyed table."""
    if read_layer(spark, layout.at("export_log"), EXPORT_LOG) is None:
        return
    load_by_name(
        spark, layout.at("exports"), layout.at("landing"), layout.at("checkpoints/landing"), GOLD, pace=layout.pace
    )
    triggered_upsert(
        spark,
        layout.at("landing"),
        keyed_table(spark, layout),
        layout.at("checkpoints/master"),
        layout.at("runs"),
        pace=layout.pace,
    )


STEPS = (refine_silver, refine_gold, publish, load_master)


def refresh_models(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The dimension as a view of the keyed table, and the marts brought up to its last commit."""
    table = keyed_table(spark, layout)
    table.settle()
    marts = IncrementalMarts(table, layout.at("cells"))
    marts.refresh()
    return {"dim_provider": dimension(table.read()), **{name: marts.read(name) for name in MARTS}}


def run_all(spark: SparkSession, layout: Layout, processed: str) -> dict[str, DataFrame]:
    """Every step once over what is new; running it again without new files adds nothing."""
    ingest_files(spark, processed, layout.at("bronze"), layout.at("checkpoints/bronze"), pace=layout.pace)
    for step in STEPS:
        step(spark, layout)
    return refresh_models(spark, layout)
