"""Exact top-k by inner product: the threshold algorithm over sorted per-dimension lists.

The vectors are cut into blocks, and so are the queries. Within a block of vectors every dimension
has a list of its vectors by value. A query goes down all lists together, from the top where its
own component is positive and from the bottom where it is negative, and scores the vectors it
meets. What is still unmet can't score more than the sum of the query's components times the
values where the lists stand; once that bound is below the k-th best score, the block is done.
Equal bounds go on, since a tie goes to the smaller id. The best of the blocks are merged.

Vectors that are null, empty, or hold a null or non-finite component take no part, neither do rows
without an id. Vectors of unlike length aren't compared. Repeated ids each count as a candidate;
a query finds no row with its own id. Scaled components, and scores, beyond what a long holds count as
the largest one. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VECTORS, QUERIES = 4_096, 1_024
FIRST, GROWTH = 16, 4
#: Components and scores beyond it count as this.
LARGEST = 2**63 - 1024


def scaled(vector: Column, factor: int = 256) -> Column:
    """Whole numbers floor(factor * x), with x as double."""
    wide = F.lit(float(LARGEST))
    return F.transform(vector, lambda x: F.floor(F.greatest(-wide, F.least(wide, factor * x.cast("double")))).cast("long"))


def usable(vector: Column) -> Column:
    inf = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < inf))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def block_top(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query id, id, score) of each query's k best in this block."""
    n, dims = vectors.shape
    by_value = np.argsort(vectors, axis=0, kind="stable")
    sorted_values = np.take_along_axis(vectors, by_value, axis=0)
    # scores are whole numbers; doubles hold them exactly up to 2**53
    exact = float(np.abs(vectors.astype(np.float64)).max(initial=0)) * float(np.abs(queries.astype(np.float64)).max(initial=0)) * dims < 2**53
    matrix = vectors.astype(np.float64) if exact else vectors.astype(object)
    columns = np.arange(dims)
    out = []
    for query_id, query in zip(query_ids, queries):
        q = query.astype(matrix.dtype)
        upward = query < 0
        met = np.zeros(n, bool)
        best_ids, best = np.empty(0, ids.dtype), np.empty(0, matrix.dtype)
        at, depth = 0, FIRST
        while at < n:
            until = min(n, depth)
            rows = np.where(upward[None, :], np.arange(at, until)[:, None], n - 1 - np.arange(at, until)[:, None])
            fresh = by_value[rows, columns].ravel()
            before = met.copy()
            met[fresh] = True
            fresh = np.flatnonzero(met & ~before)
            fresh = fresh[ids[fresh] != query_id]
            if len(fresh):
                best = np.concatenate([best, matrix[fresh] @ q])
                best_ids = np.concatenate([best_ids, ids[fresh]])
                order = np.lexsort((best_ids, -best))[:k]
                best, best_ids = best[order], best_ids[order]
            at, depth = until, depth * GROWTH
            if at < n and len(best) == k:
                edge = np.where(upward, sorted_values[at, columns], sorted_values[n - 1 - at, columns])
                if (edge.astype(matrix.dtype) * q).sum() < best[-1]:
                    break
        out += [(int(query_id), int(i), int(s)) for i, s in zip(best_ids, best)]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector: str = "vector") -> DataFrame:
    """query_id, rank (from 1), vec_id, score. Both tables have an id and a vector of whole numbers.

    Every block of vectors meets every block of queries, so a table of n vectors is sent once for
    each ``QUERIES`` queries, and no task holds more than one block of either.
    """
    n_vectors, n_queries = vectors.count(), queries.count()
    v_blocks, q_blocks = max(1, -(-n_vectors // VECTORS)), max(1, -(-n_queries // QUERIES))

    def dealt(rows: DataFrame, own: int, other: int, own_name: str, other_name: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(id_column, vector), F.lit(own)).cast("int")
        return rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"), F.size(vector).alias("dims"),
                           mine.alias(own_name), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(other_name))

    keys = ["vb", "qb", "dims"]
    left = dealt(vectors, v_blocks, q_blocks, "vb", "qb").groupBy(*keys)
    right = dealt(queries, q_blocks, v_blocks, "qb", "vb").groupBy(*keys)

    def run(a, b):
        found = []
        if a.num_rows and b.num_rows:
            (ids, rows), (query_ids, query_rows) = (
                (t.column("id").to_numpy(), pc.list_flatten(t.column("v")).to_numpy().reshape(t.num_rows, -1)) for t in (a, b))
            found = [(q, i, max(-LARGEST, min(LARGEST, s))) for q, i, s in block_top(ids, rows, query_ids, query_rows, k)]
        return pa.table({name: pa.array([x[i] for x in found], pa.int64()) for i, name in enumerate(("query_id", "vec_id", "score"))})

    near = left.cogroup(right).applyInArrow(run, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k nearest of every ``every``-th vector among all others."""
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        "vec_id", scaled(F.col("embedding")).alias("vector"))
    return top_k(rows, rows.where(F.col("vec_id") % every == 0), k)
