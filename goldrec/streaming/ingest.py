"""Incremental file ingestion. Each file is taken exactly once per checkpoint."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter, StreamingQuery

from goldrec.schemas import BRONZE, GOLD
from goldrec.sources.files import OPENED, open_staged
from goldrec.sources.tables import conform
from goldrec.streaming.ledger import PACE, FileLedger, Staged, at_intervals, drain, literal_path

LANDING = T.StructType([
    *GOLD.fields,
    T.StructField("FAILED_COLUMNS", T.ArrayType(T.StringType())),
    T.StructField("ORIGINAL", T.StringType()),
    T.StructField("SOURCE_FILE", T.StringType()),
    T.StructField("LOADED_AT", T.TimestampType()),
    T.StructField("LOAD", T.StringType()),
    T.StructField("REJECTED", T.BooleanType()),
])
FILES = T.StructType([
    T.StructField("FILE_PATH", T.StringType()),
    T.StructField("ROWS", T.LongType()),
    T.StructField("LOADED_AT", T.TimestampType()),
    T.StructField("STATUS", T.StringType()),
    T.StructField("REASON", T.StringType()),
])
PROBED = T.StructType([
    T.StructField("FILE_PATH", T.StringType()),
    T.StructField("ROWS", T.LongType()),
    T.StructField("COLUMNS", T.StringType()),
    T.StructField("REASON", T.StringType()),
])
KEEP = "36500d"  # the job's own layers are streamed too; files that were put back with old times are still new


def paced(reader: DataStreamReader, pace: int | None = PACE) -> DataStreamReader:
    reader = reader.option("recursiveFileLookup", False).option("maxFileAge", KEEP)
    return reader.option("maxBytesPerTrigger", pace) if pace else reader


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Drain what is there and stop, or with ``every`` keep running at that interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _run(spark: SparkSession, checkpoint: str, every: str | None, run) -> StreamingQuery | int:
    return at_intervals(spark, every, f"{checkpoint}/ticks", run) if every else run()


def ingest_files(
    spark: SparkSession,
    source: str,
    bronze: str,
    checkpoint: str,
    multiline: bool = False,
    every: str | None = None,
    pace: int = PACE,
) -> StreamingQuery | int:
    """Append new envelope files to the bronze table; how many micro-batches, or with ``every`` the running query.

    ``multiline`` reads files that hold one JSON array; JSON Lines files need no option and can be
    split. A micro-batch writes a folder of its own, which a repeated one writes over.
    """
    ledger = FileLedger(spark, f"{checkpoint}/files")

    def take(files: list[Staged], epoch: int) -> None:
        paths = [literal_path(f.path) for f in files if not f.changed]
        if paths:
            rows = spark.read.schema(BRONZE).option("multiLine", multiline).json(paths)
            rows.write.mode("overwrite").parquet(f"{bronze}/EPOCH={epoch}")

    return _run(spark, checkpoint, every, lambda: drain(spark, source, ledger, take, pace=pace))


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(bronze).select(*BRONZE.names)


def _footer(path: str, length: int) -> pa.Buffer:
    """The end of a file: footer, its length and the mark. Errors here are the store's, not the file's."""
    with open_staged(path) as file:
        tail = file.read_at(min(8, length), max(0, length - 8))
        size = int.from_bytes(tail[:4], "little") + 8
        return pa.py_buffer(tail if len(tail) < 8 or size > length else file.read_at(size, length - size))


def _described(footer: pa.Buffer) -> tuple[int | None, str | None, str | None]:
    """Rows, columns and reason: what a footer says, or why it can't be read."""
    if footer.size < 8 or footer.to_pybytes()[-4:] != b"PAR1":
        return None, None, "NOT_PARQUET"
    try:
        found = pq.read_metadata(pa.BufferReader(footer))
        return found.num_rows, json.dumps([[f.name, str(f.type)] for f in found.schema.to_arrow_schema()]), None
    except Exception:  # only bytes at hand are parsed here, so whatever it is, it is the file
        return None, None, "BROKEN_FOOTER"


def probe(spark: SparkSession, files: Sequence[Staged]) -> DataFrame:
    """One row per file, from its footer alone: rows and columns, or the reason why it can't be read.

    The files are dealt to tasks. A store that fails raises; only what a file's bytes say marks it.
    """
    listed = spark.createDataFrame([(f.path, f.length) for f in files], "FILE_PATH string, BYTES long")
    tasks = max(1, min(len(files) // 32, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("FILE_PATH").to_pylist()
            found = [_described(_footer(p, n)) for p, n in zip(paths, batch.column("BYTES").to_pylist())]
            columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("FILE_PATH"), *columns], names=PROBED.names)

    return listed.repartition(tasks, "FILE_PATH").mapInArrow(run, PROBED)


def readable_together(found: Sequence[tuple[str, str]]) -> list[list[str]]:
    """Paths in groups whose columns agree: no name has two types or two spellings in a group."""
    by_columns: dict[str, list[str]] = {}
    for path, columns in found:
        by_columns.setdefault(columns, []).append(path)
    groups: list[tuple[dict[str, tuple[str, str]], list[str]]] = []
    for columns, paths in sorted(by_columns.items()):
        named = {name.lower(): (name, kind) for name, kind in json.loads(columns)}
        for held, members in groups:
            if all(held.get(k, v) == v for k, v in named.items()):
                held.update(named)
                members += paths
                break
        else:
            groups.append((dict(named), list(paths)))
    return [sorted(members) for _, members in groups]


def _staged_rows(spark: SparkSession, groups: Sequence[list[str]], wire: T.StructType | None) -> DataFrame:
    """The rows of all groups in the golden columns; one plan for each group."""
    # file metadata has the path as an escaped URI, the list of files as the file system names it
    named = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = None
    for paths in groups:
        reader = spark.read.schema(wire) if wire else spark.read.option("mergeSchema", True)
        part = reader.parquet(*map(literal_path, paths)).withColumn("SOURCE_FILE", named)
        part = conform(part, GOLD, carry=("SOURCE_FILE",))
        rows = part if rows is None else rows.unionByName(part)
    return rows.withColumn("LOADED_AT", F.current_timestamp()).withColumn("REJECTED", F.size("FAILED_COLUMNS") > 0)


def _failed_while_reading(error: Exception) -> bool:
    return isinstance(error, (PySparkException, Py4JJavaError)) and "FAILED_READ_FILE" in str(error)


def _broken_pages(spark: SparkSession, groups: Sequence[list[str]], rows: dict[str, int], wire: T.StructType | None) -> set[str]:
    """Files that give fewer rows than their footers say once every column is read."""
    setting = "spark.sql.files.ignoreCorruptFiles"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        read = _staged_rows(spark, groups, wire)
        whole = F.bit_xor(F.xxhash64(*[c for c in read.columns if c not in ("SOURCE_FILE", "LOADED_AT")]))
        counted = read.groupBy("SOURCE_FILE").agg(F.count(F.lit(1)).alias("n"), whole.alias("all")).collect()
    finally:
        spark.conf.set(setting, before)
    given = {r["SOURCE_FILE"]: r["n"] for r in counted}
    return {path for paths in groups for path in paths if given.get(path, 0) < rows[path]}


def load_files(
    spark: SparkSession, files: Sequence[Staged], landing: str, load: str, wire_schema: T.StructType | None = None
) -> None:
    """Land staged files under the name ``load``, in one folder, and list what each gave.

    A file goes to the audit as UNREADABLE only for what its own bytes say: its footer, or pages that
    give fewer rows than it promises. Any other error, such as a folder that can't be written or a
    store that doesn't answer, is raised and nothing is listed. Doing it again writes the same
    folder over. Changed files are listed as CHANGED and not loaded.
    """
    new = [f for f in files if not f.changed]
    # a store that only Spark's readers open isn't probed: whatever is wrong there is raised
    opened = all(f.path.partition(":")[0] in OPENED for f in new)
    found = probe(spark, new).collect() if opened and new else [(f.path, None, "[]", None) for f in new]
    rows = {path: n for path, n, _, reason in found if not reason}
    reasons = {path: reason for path, _, _, reason in found if reason}
    readable = [(path, "" if wire_schema else columns) for path, _, columns, reason in found if not reason]
    groups = [[path for path, _ in readable]] if wire_schema and readable else readable_together(readable)
    while groups:
        try:
            _staged_rows(spark, groups, wire_schema).hint("rebalance").write.mode("overwrite").partitionBy("REJECTED").parquet(f"{landing}/LOAD={load}")
            break
        except Exception as error:
            if not opened or not _failed_while_reading(error):
                raise
            broken = _broken_pages(spark, groups, rows, wire_schema)
            if not broken:
                raise
            reasons |= dict.fromkeys(broken, "BROKEN_PAGES")
            groups = [left for paths in groups if (left := [p for p in paths if p not in broken])]
    told = [(p, "UNREADABLE", reason) for p, reason in reasons.items()] + [(f.path, "CHANGED", None) for f in files if f.changed]
    told += [(p, "LOADED", None) for paths in groups for p in paths]
    audit = spark.createDataFrame(told, "FILE_PATH string, STATUS string, REASON string")
    zero = F.lit(0).cast("long")
    if groups:
        landed = spark.read.schema(LANDING).parquet(f"{landing}/LOAD={load}")
        audit = audit.join(landed.groupBy(F.col("SOURCE_FILE").alias("FILE_PATH")).agg(F.count(F.lit(1)).alias("ROWS")), "FILE_PATH", "left")
    else:
        audit = audit.withColumn("ROWS", zero)
    audit = audit.withColumns({"ROWS": F.coalesce("ROWS", zero), "LOADED_AT": F.current_timestamp()})
    audit.select(*FILES.names).coalesce(1).write.mode("overwrite").parquet(f"{landing}_files/LOAD={load}")


def load_paths(
    spark: SparkSession, paths: Sequence[str], landing: str, load: str, wire_schema: T.StructType | None = None
) -> None:
    """Load these files, whatever the ledger has of them: an unreadable one that was mended, a changed one."""
    listed = spark.read.format("binaryFile").load([literal_path(p) for p in paths]).select("path", "length", "modificationTime")
    load_files(spark, [Staged(*r, False) for r in listed.collect()], landing, load, wire_schema)


def load_by_name(
    spark: SparkSession,
    staged: str,
    landing: str,
    checkpoint: str,
    wire_schema: T.StructType | None = None,
    every: str | None = None,
    pace: int = PACE,
) -> StreamingQuery | int:
    """Append new staged Parquet files to landing, columns matched by name; how many loads, or the running query.

    Each micro-batch of files lands in a folder of its own and is then entered in the ledger, so a
    load that failed is made again. Files of no bytes are not listed by Spark. Rows that do not cast are kept apart as rejects by partition,
    files that can't be read in the audit. Files staged before the first run are loaded too, and
    files with old times, which makes a backfill the same call. ``wire_schema`` gives the types as
    staged; by default each file's own footer does.
    """
    ledger = FileLedger(spark, f"{checkpoint}/files")

    def take(files: list[Staged], epoch: int) -> None:
        load_files(spark, files, landing, f"{epoch:012d}", wire_schema)

    return _run(spark, checkpoint, every, lambda: drain(spark, staged, ledger, take, "*.parquet", pace))


def read_landing(spark: SparkSession, landing: str) -> DataFrame:
    """The accepted rows, in the golden columns."""
    rows = spark.read.schema(LANDING).parquet(landing)
    return rows.filter("NOT REJECTED").select(*GOLD.names)


def read_rejects(spark: SparkSession, landing: str) -> DataFrame:
    rows = spark.read.schema(LANDING).parquet(landing)
    return rows.filter("REJECTED").select("FAILED_COLUMNS", "ORIGINAL", "SOURCE_FILE", "LOADED_AT")


def loaded_files(spark: SparkSession, landing: str) -> DataFrame:
    """One row per file and attempt: rows, time, status and reason. Written while loading."""
    return spark.read.schema(FILES).parquet(f"{landing}_files").select(*FILES.names)
