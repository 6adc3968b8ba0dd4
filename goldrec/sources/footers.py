"""What Parquet footers know of a written layer: rows and NULLs, without reading its data."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.operators.payload import null_report
from goldrec.sources.files import OPENED, open_staged
from goldrec.sources.history import list_staged

COUNTS = "FILE_PATH string, ROWS long, NAME string, NULLS long, KNOWN boolean"


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per file and column of a layer: its rows, its NULLs, and whether the footer says so (KNOWN).

    NAME is NULL in one row per file, which holds its rows. The files are dealt to tasks.
    """
    listed = list_staged(spark, path).select("FILE_PATH")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column("FILE_PATH").to_pylist():
                with open_staged(name) as file:
                    meta = pq.read_metadata(file)
                rows.append((name, meta.num_rows, None, 0, True))
                groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
                for c in range(meta.num_columns):
                    found = [g.column(c).statistics for g in groups]
                    known = all(x is not None and x.has_null_count for x in found)
                    nulls = sum(x.null_count for x in found) if known else 0
                    rows.append((name, meta.num_rows, meta.schema.column(c).path, nulls, known))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["FILE_PATH", "ROWS", "NAME", "NULLS", "KNOWN"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return listed.repartition(tasks, "FILE_PATH").mapInArrow(run, COUNTS)


def footer_null_report(spark: SparkSession, path: str, layer: DataFrame) -> DataFrame:
    """:func:`null_report` of a layer of flat columns, from its footers: one wide row.

    A column that files lack is NULL there. Where a footer is silent about a column, or the store is
    one that only Spark's readers open, the layer is read instead.
    """
    scheme = list_staged(spark, path).select(F.split_part("FILE_PATH", F.lit(":"), F.lit(1)).alias("s")).distinct()
    if not scheme.filter(~F.col("s").isin(*OPENED)).isEmpty():
        return null_report(layer)
    counts = footer_counts(spark, path)
    names = layer.columns
    per = counts.groupBy().agg(
        F.sum(F.when(F.col("NAME").isNull(), F.col("ROWS"))).alias("_rows"),
        F.bool_and("KNOWN").alias("_known"),
        *[F.sum(F.when(F.col("NAME") == c, F.col("ROWS") - F.col("NULLS"))).alias(f"_{i}") for i, c in enumerate(names)],
    ).collect()[0]  # one row of sums
    if not per["_known"]:
        return null_report(layer)
    rows = per["_rows"]
    shares = [(None if not rows else (rows - (per[f"_{i}"] or 0)) / rows * 100) for i in range(len(names))]
    return spark.createDataFrame([tuple(shares)], ", ".join(f"`{c}_null_pct` double" for c in names))


def footer_layer_counts(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Rows per layer (name: folder), from footers."""
    combined = None
    for name, path in layers.items():
        rows = footer_counts(spark, path).filter("NAME IS NULL").agg(F.coalesce(F.sum("ROWS"), F.lit(0).cast("long")).alias("TOTAL_RECORDS"))
        part = rows.select(F.lit(name).alias("LAYER"), "TOTAL_RECORDS")
        combined = part if combined is None else combined.unionByName(part)
    return combined
