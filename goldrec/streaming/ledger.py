"""Which staged files were taken: by path, length and time, whatever their age.

A file stream forgets by age and knows files by path alone: a file that comes late with an old time
is passed over, and new content under an old path is not seen. Here the listing is compared with
a table of what was taken. A file is new if its path isn't there, and changed if its path is there with
another length or time. A changed file is told once for each content and not taken, since its first
rows are loaded already.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from goldrec.sources.history import list_staged

PACE = 64 * 2**30  # bytes of input of one micro-batch; a backlog takes several, and nothing is left out
FILES = 10_000  # files of one micro-batch: their names pass through the driver

ENTRY = T.StructType([
    T.StructField("FILE_PATH", T.StringType()),
    T.StructField("BYTES", T.LongType()),
    T.StructField("MODIFIED_AT", T.TimestampType()),
    T.StructField("STATE", T.StringType()),
    T.StructField("TAKEN_AT", T.TimestampType()),
    T.StructField("EPOCH", T.LongType()),
])


class Staged(NamedTuple):
    """A file as the listing shows it; ``changed`` if the ledger knows its path with other content."""

    path: str
    length: int
    modified: datetime
    changed: bool


def literal_path(path: str) -> str:
    """The path for a reader, which takes some characters for patterns."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


class FileLedger:
    """A folder for each micro-batch, written when its files have been taken."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(ENTRY).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], ENTRY)
            raise

    def next_epoch(self) -> int:
        last = self.entries().agg(F.max("EPOCH")).first()[0]
        return 0 if last is None else last + 1

    def untaken(self, listed: DataFrame) -> DataFrame:
        """Listed files without an entry of the same path, length and time, and whether the path has one."""
        known = self.entries().groupBy("FILE_PATH").agg(F.collect_set(F.struct("BYTES", "MODIFIED_AT")).alias("_contents"))
        same = F.array_contains("_contents", F.struct("BYTES", "MODIFIED_AT"))
        return (
            listed.join(known, "FILE_PATH", "left")
            .filter(~F.coalesce(same, F.lit(False)))
            .select("FILE_PATH", "BYTES", "MODIFIED_AT", F.col("_contents").isNotNull().alias("CHANGED"))
        )

    def commit(self, epoch: int, files: Sequence[Staged]) -> None:
        rows = [(f.path, f.length, f.modified, "CHANGED" if f.changed else "TAKEN") for f in files]
        entry = self.spark.createDataFrame(rows, T.StructType(ENTRY.fields[:4])).withColumn("TAKEN_AT", F.current_timestamp())
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/EPOCH={epoch}")

    def changed(self) -> DataFrame:
        """Files that were staged again under the path of one that was taken."""
        return self.entries().filter("STATE = 'CHANGED'")


def _pages(files: DataFrame, size: int) -> Iterator[list[Staged]]:
    """The files by time and path, at most ``size`` at once."""
    order, last = ("MODIFIED_AT", "FILE_PATH"), None
    while True:
        rest = files if last is None else files.filter(F.struct(*order) > F.struct(F.lit(last.modified), F.lit(last.path)))
        page = [Staged(*r) for r in rest.orderBy(*order).limit(size).collect()]
        if page:
            yield page
            last = page[-1]
        if len(page) < size:
            return


def _paced(page: Sequence[Staged], pace: int) -> Iterator[list[Staged]]:
    """Parts of the page of at most ``pace`` bytes, or of one file."""
    some, size = [], 0
    for f in page:
        if some and size + f.length > pace:
            yield some
            some, size = [], 0
        some.append(f)
        size += f.length
    if some:
        yield some


def has_files(spark: SparkSession, source: str, ledger: FileLedger, pattern: str) -> bool:
    """Whether anything is staged that the ledger doesn't have; file contents are not read."""
    return not ledger.untaken(list_staged(spark, source, pattern)).isEmpty()


def drain(
    spark: SparkSession,
    source: str,
    ledger: FileLedger,
    take: Callable[[list[Staged], int], None],
    pattern: str = "*",
    pace: int = PACE,
    page: int = FILES,
) -> int:
    """Take what is staged and not taken yet, one micro-batch after another; how many there were.

    ``take`` gets the files and the number of the micro-batch, under which it must write all it
    writes: if it fails, the ledger doesn't change, and the next run calls it with that number again.
    """
    untaken = ledger.untaken(list_staged(spark, source, pattern))
    first = epoch = ledger.next_epoch()
    for files in _pages(untaken, page):
        for some in _paced(files, pace):
            take(some, epoch)
            ledger.commit(epoch, some)
            epoch += 1
    return epoch - first


def at_intervals(spark: SparkSession, every: str, checkpoint: str, run: Callable[[], None]) -> StreamingQuery:
    """Call ``run`` at that interval until the query is stopped; an error of it ends the query."""
    ticks = spark.readStream.format("rate").load().writeStream.foreachBatch(lambda _, __: run())
    return ticks.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
