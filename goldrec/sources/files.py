"""Registry responses, envelope files and their archive."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.operators.payload import BatchStamp, envelopes
from goldrec.operators.standardize import Pick, explode_results, flatten_providers
from goldrec.schemas import BRONZE, RAW

CHUNK = 4 * 2**20  # bytes of a row of the archive
FILE_ROWS = 16  # rows of a file of the archive
ENVELOPE_ROWS = 100_000  # rows of an envelope file, some 250 MB of text
TEXT_LIMIT = 256 * 2**20  # bytes of the largest response that is given as one text
#: File systems that a task can open without Spark's readers.
OPENED = ("file", "s3", "gs", "hdfs")


def read_responses(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Response documents. ``multiline`` reads one pretty-printed document per file."""
    return spark.read.schema(RAW).option("multiLine", multiline).json(path)


def read_registry(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row per provider of every response."""
    return explode_results(read_responses(spark, path, multiline))


def read_envelopes(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Envelope files: JSON Lines, or with ``multiline`` one JSON array per file."""
    return spark.read.schema(BRONZE).option("multiLine", multiline).json(path)


def write_envelopes(rows: DataFrame, path: str) -> None:
    """Envelope rows as gzipped JSON Lines: a payload repeats its field names and methods in every row.

    A gzipped file is read by one task, so none has more than ENVELOPE_ROWS rows.
    """
    writer = rows.write.mode("append").option("maxRecordsPerFile", ENVELOPE_ROWS)
    writer.option("compression", "gzip").option("ignoreNullFields", False).json(path)


def open_staged(path: str) -> pa.NativeFile:
    """A file of the listing, for reading parts of it within a task."""
    if path.startswith("file:"):
        return LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    system, place = FileSystem.from_uri(path)
    return system.open_input_file(place)


def archive_raw(spark: SparkSession, source: str, archive: str, run: str, chunk: int = CHUNK) -> None:
    """Keep every response file byte for byte, with its name, under one folder per run.

    A file is rows of at most ``chunk`` bytes, which different tasks copy: no file is too large for a
    row or for a task. Writing to a run folder that exists fails, so an archived run is never altered.
    A store that only Spark's readers open is copied file by file.
    """
    files = spark.read.format("binaryFile").load(source).select(
        F.col("path").alias("FILE_PATH"), F.col("modificationTime").alias("MODIFIED_AT"), F.col("length").alias("BYTES"), "content")
    listed = files.drop("content")
    if listed.filter(~F.col("FILE_PATH").rlike(f"^({'|'.join(OPENED)}):")).isEmpty():
        last = F.greatest(F.ceil(F.col("BYTES") / chunk) - 1, F.lit(0)).cast("int")
        places = listed.select("*", F.explode(F.sequence(F.lit(0), last)).alias("CHUNK"))

        def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    one = batch.slice(row, 1)
                    path, size, at = (one.column(c)[0].as_py() for c in ("FILE_PATH", "BYTES", "CHUNK"))
                    with open_staged(path) as file:
                        part = file.read_at(min(chunk, size - at * chunk), at * chunk)
                    yield pa.RecordBatch.from_arrays([*one.columns, pa.array([part], pa.binary())], names=[*one.schema.names, "content"])

        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        schema = places.withColumn("content", F.lit(b"")).schema
        rows = places.repartition(tasks, "FILE_PATH", "CHUNK").mapInArrow(run_, schema)
    else:
        rows = files.withColumn("CHUNK", F.lit(0)).select("FILE_PATH", "MODIFIED_AT", "BYTES", "CHUNK", "content")
    # a row is large: readers take a file's rows at once, and a page would hold a hundred of them
    writer = rows.write.mode("error").option("maxRecordsPerFile", FILE_ROWS)
    for name in ("parquet.page.size.row.check.min", "parquet.page.size.row.check.max"):
        writer = writer.option(name, 1)
    writer.parquet(f"{archive}/run={run}")


def _inflated(content: Column) -> Column:
    """The bytes of gzipped content, of one member or several; NULL if they are more than TEXT_LIMIT."""
    limit = TEXT_LIMIT

    def run(packed):
        found, size = [], 0
        while packed:
            member = zlib.decompressobj(31)
            found.append(member.decompress(packed, limit + 1 - size))
            size += len(found[-1])
            if size > limit:
                return None
            if not member.eof:
                raise EOFError("gzipped response is cut short")
            packed = member.unused_data.lstrip(b"\0")  # members may be padded
        return b"".join(found) if found else packed

    return F.udf(run, "binary")(content)


def read_archive(spark: SparkSession, archive: str) -> DataFrame:
    """Archived responses of all runs as text, next to their origin; NULL for a file of more than TEXT_LIMIT bytes.

    The archive has the bytes as they came; a gzipped response is inflated here.
    """
    rows = spark.read.parquet(archive)
    origin = [c for c in rows.columns if c not in ("CHUNK", "content")]
    small = F.col("BYTES") <= TEXT_LIMIT
    parts = F.collect_list(F.when(small, F.struct("CHUNK", F.hex("content").alias("hex"))))
    whole = rows.groupBy(*origin).agg(F.sort_array(parts).alias("_parts"))
    content = F.unhex(F.array_join("_parts.hex", ""))
    packed = F.col("FILE_PATH").endswith(".gz")
    # a function of Python sees every row, whatever the branch: the others go to it as NULL
    content = F.when(packed, _inflated(F.when(packed, content))).otherwise(content)
    return whole.select(*origin, F.when(small, F.decode(content, "UTF-8")).alias("RESPONSE"))


def archive_digests(spark: SparkSession, archive: str) -> DataFrame:
    """Per archived file its origin, its bytes as archived and their SHA-256, read chunk after chunk."""
    rows = spark.read.parquet(archive)
    origin = [c for c in rows.columns if c not in ("CHUNK", "content", "BYTES")]

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, size = None, None, 0

        def found() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*held.columns, pa.array([size], pa.int64()), pa.array([digest.hexdigest()])], names=[*origin, "BYTES", "SHA256"])

        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).select(origin)
                if held is None or one.to_pylist() != held.to_pylist():
                    if held is not None:
                        yield found()
                    held, digest, size = one, hashlib.sha256(), 0
                part = batch.column("content")[row].as_buffer()
                digest.update(part)
                size += part.size
        if held is not None:
            yield found()

    schema = rows.select(*origin, F.lit(0).cast("long").alias("BYTES"), F.lit("").alias("SHA256")).schema
    in_order = rows.repartition(*origin).sortWithinPartitions(*origin, "CHUNK").select(*origin, "content")
    return in_order.mapInArrow(run_, schema)


def extract(
    spark: SparkSession, raw: str, processed: str, stamp: BatchStamp, pick: Pick = Pick()
) -> None:
    """Raw responses to envelope files in one plan: flatten, build payloads, write."""
    flat = flatten_providers(read_registry(spark, raw), pick)
    write_envelopes(envelopes(flat, stamp), f"{processed}/{stamp.batch_id}")
