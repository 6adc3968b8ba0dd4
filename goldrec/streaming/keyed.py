"""Upserts by key: commits of changes over a base of settled rows."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.operators.skew import row_hash
from goldrec.schemas import GOLD


def newest_per_key(df: DataFrame, key: str, newest: str = "LOAD_TIMESTAMP") -> DataFrame:
    """One row per key, the newest; rows with a NULL key all stay.

    The rank filter keeps one row per key and input partition before the shuffle.
    """
    window = Window.partitionBy(key).orderBy(F.desc_nulls_last(newest), row_hash(df))
    keyed = df.filter(F.col(key).isNotNull())
    best = keyed.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1")
    return best.drop("_rank").unionByName(df.filter(F.col(key).isNull()))


def upsert(target: DataFrame, source: DataFrame, key: str, newest: str = "LOAD_TIMESTAMP") -> DataFrame:
    """Target rows of unknown keys and the newest source row of each key; NULL keys are added."""
    fresh = newest_per_key(source.select(*target.columns), key, newest)
    return target.join(fresh.select(key), key, "left_anti").select(*target.columns).unionByName(fresh)


def merge_into(source: DataFrame, table: str, key: str, newest: str = "LOAD_TIMESTAMP") -> None:
    """The same upsert into a catalog table whose format has row-level MERGE; others raise."""
    fresh = newest_per_key(source, key, newest)
    merged = fresh.alias("s").mergeInto(table, F.expr(f"{table}.{key} = s.{key}"))
    merged.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of finished folders that match, as the file system lists them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    marks = place(f"{pattern}/_SUCCESS")
    system = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getParent().toString() for status in system.globStatus(marks) or []]


class KeyedTable:
    """Commits as they came, over a base of the rows that were current at one of them.

    A commit writes its own folder and costs what its source costs. Making it again writes the
    same folder again, so a replay changes nothing. ``settle`` writes a new base once the commits after
    the last one have grown to a share of it, so that reading costs about what the current rows
    cost, however many commits there were. The base is bucketed by key: what is newer is brought
    to it, and it is never shuffled, neither when reading nor when settling. Reading writes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "ProviderID", schema: T.StructType = GOLD):
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema

    def _write(self, rows: DataFrame, commit: int) -> int:
        written = Observation()
        counted = rows.select(*self.schema.names).observe(written, F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(f"{self.path}/COMMIT={commit}")
        return written.get["n"]

    def load(self, rows: DataFrame, commit: int = 0) -> int:
        """All rows without a key check, as a one-off first load does."""
        return self._write(rows, commit)

    def merge(self, source: DataFrame, commit: int, newest: str = "LOAD_TIMESTAMP") -> int:
        """Upsert: each key's newest source row replaces what earlier commits hold of the key."""
        return self._write(newest_per_key(source.select(*self.schema.names), self.key, newest), commit)

    def commits(self) -> list[int]:
        return sorted(int(re.search(r"COMMIT=(-?\d+)$", f)[1]) for f in folders(self.spark, f"{self.path}/COMMIT=*"))

    def bases(self) -> dict[int, int]:
        """The commit that each base stands for, and its buckets."""
        found = (re.search(r"BASE=(-?\d+)/KEYED=(\d+)$", f) for f in folders(self.spark, f"{self.path}/BASE=*/KEYED=*"))
        return {int(m[1]): int(m[2]) for m in found}

    def changes(self, after: int | None = None, until: int | None = None) -> DataFrame:
        """The rows of the commits, each with its number (COMMIT)."""
        schema = T.StructType([*self.schema.fields, T.StructField("COMMIT", T.LongType())])
        wanted = [c for c in self.commits() if (after is None or c > after) and (until is None or c <= until)]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/COMMIT={c}" for c in wanted]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def _base_name(self, at: int) -> str:
        return f"keyed_{hashlib.sha256(f'{self.path} {at}'.encode()).hexdigest()[:24]}"

    def _base(self, at: int, buckets: int) -> DataFrame:
        """Settled rows: those with a key as a bucketed table over their folder, the others beside it."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._base_name(at)} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) "
            f"INTO {buckets} BUCKETS LOCATION '{self.path}/BASE={at}/KEYED={buckets}'")
        return self.spark.table(self._base_name(at))

    def _keyless(self, at: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/BASE={at}/KEYLESS")

    def _newest(self, rows: DataFrame) -> DataFrame:
        """The rows of each key's newest commit, and all rows without a key.

        Newest commits are counted out before their shuffle, one row per key; adaptive execution
        splits a key with very many changes.
        """
        keyed = rows.filter(F.col(self.key).isNotNull())
        last = keyed.groupBy(self.key).agg(F.max("COMMIT").alias("COMMIT"))
        current = keyed.join(last, [self.key, "COMMIT"], "left_semi")
        return current.unionByName(rows.filter(F.col(self.key).isNull())).select(*self.schema.names)

    def read(self, until: int | None = None) -> DataFrame:
        """The current rows, or those as of a commit."""
        bases = {at: n for at, n in self.bases().items() if until is None or at <= until}
        if not bases:
            return self._newest(self.changes(until=until))
        at = max(bases)
        fresh = self._newest(self.changes(at, until))
        kept = self._base(at, bases[at]).join(fresh.select(self.key), self.key, "left_anti").select(*self.schema.names)
        return kept.unionByName(self._keyless(at)).unionByName(fresh)

    def settle(self, share: float = 0.5, buckets: int | None = None) -> bool:
        """Write a new base if the commits after the last one hold more than ``share`` of its rows.

        The base is not shuffled for that: each of its tasks writes its own bucket again, and the
        newer rows are brought to the same buckets. The number of buckets is taken from the session once.
        """
        bases, commits = self.bases(), self.commits()
        at = max(bases, default=None)
        newer = [c for c in commits if at is None or c > at]
        if not newer:
            return False
        if at is not None:
            held = self._base(at, bases[at]).count() + self._keyless(at).count()
            if self.changes(at).count() <= share * held:
                return False
        buckets = buckets or bases.get(at) or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        fresh = self._newest(self.changes(at))
        keyed = fresh.filter(F.col(self.key).isNotNull()).repartition(buckets, self.key)
        keyless = fresh.filter(F.col(self.key).isNull())
        if at is not None:
            kept = self._base(at, bases[at]).join(fresh.select(self.key), self.key, "left_anti").select(*self.schema.names)
            keyed, keyless = kept.unionByName(keyed), self._keyless(at).unionByName(keyless)
        to, name = newer[-1], self._base_name(newer[-1])
        keyless.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/BASE={to}/KEYLESS")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        writer = keyed.write.format("parquet").mode("overwrite").bucketBy(buckets, self.key).sortBy(self.key)
        writer.option("path", f"{self.path}/BASE={to}/KEYED={buckets}").saveAsTable(name)
        return True

    def signed_changes(self, commit: int) -> DataFrame:
        """What a commit changes: its rows (SIGN 1) and those that they replace (SIGN -1)."""
        new = self.changes(commit - 1, commit).select(*self.schema.names)
        old = self.read(until=commit - 1).join(new.select(self.key), self.key, "left_semi").select(*self.schema.names)
        return new.withColumn("SIGN", F.lit(1)).unionByName(old.withColumn("SIGN", F.lit(-1)))

    def compact(self, path: str) -> KeyedTable:
        """The current rows as the first load of a table elsewhere; later commits keep their numbers.

        The last commit may be made again there: its rows are in the load already.
        """
        table = KeyedTable(self.spark, path, self.key, self.schema)
        table.load(self.read())
        return table
