"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of integer weights over terms (its dimensions). Query
rows meet all rows in blocks: in each pair of blocks every term scatters its
weighted postings into dense score arrays of the queries that have it, the k
best of each array are selected by partition, and a last step merges the blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 4096
ROW_BLOCK = 2048
# Queries that are accumulated together; their score arrays fit a core's cache.
_ROWS_AT_ONCE = 64


def integer_weights(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component; null if the vector or any
    component is null or not finite."""
    x = vector.cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(usable, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def postings(vectors: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term the rows that have it and their weights."""
    size = np.array([len(v) for v in vectors])
    flat = np.concatenate(vectors) if len(vectors) else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(vectors)), size)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    has = flat != 0
    flat, row, term = flat[has], row[has], term[has]
    order = np.argsort(term, kind="stable")
    ends = np.searchsorted(term[order], np.arange(size.max(initial=0) + 1))
    return [(row[order[a:b]], flat[order[a:b]]) for a, b in zip(ends[:-1], ends[1:])]


def best_of_block(
    query_ids: np.ndarray, queries: list[np.ndarray], row_ids: np.ndarray,
    rows: list[np.ndarray], k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query id, row id, score)`` of each query's k best rows but itself."""
    lists = postings(rows)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(queries), _ROWS_AT_ONCE):
        ids = query_ids[at:at + _ROWS_AT_ONCE]
        scores = np.zeros((len(ids), len(rows)), dtype=np.int64)
        for (row, weight), (query, amount) in zip(lists, postings(queries[at:at + _ROWS_AT_ONCE])):
            if not len(row) or not len(query):
                continue
            if 2 * len(row) > len(rows):
                # A term of most rows: its postings as a whole array are faster.
                whole = np.zeros(len(rows), dtype=np.int64)
                whole[row] = weight
                scores[query] += amount[:, None] * whole
            else:
                scores[np.ix_(query, row)] += amount[:, None] * weight
        other = ids[:, None] != row_ids
        scores[~other] = np.iinfo(np.int64).min
        keep = min(k, len(rows))
        bar = np.partition(scores, len(rows) - keep, axis=1)[:, len(rows) - keep]
        q, r = np.nonzero((scores >= bar[:, None]) & other)
        order = np.lexsort((row_ids[r], -scores[q, r], q))
        q, r = q[order], r[order]
        first = np.searchsorted(q, q)
        top = np.arange(len(q)) - first < k
        found.append((ids[q[top]], row_ids[r[top]], scores[q[top], r[top]]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _vectors(column: pa.ChunkedArray) -> list[np.ndarray]:
    whole = column.combine_chunks()
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(np.array([len(x) for x in whole], dtype=np.int64))
    return np.split(flat, ends[:-1]) if len(ends) else []


def search(
    rows: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` rows of highest
    inner product, ties to the smaller id.

    ``rows`` and ``queries`` are ``(vec_id, weights array<long>)``; other columns
    are not read. Defined cases: rows whose id or weights are null take no part;
    missing components are zeros, so an empty vector scores 0; every row is a
    candidate, so an id that rows share may come more than once; query rows that
    share an id are one query with the candidates of all; a query never meets
    its own id; with fewer than ``k`` others all are returned; with empty tables
    nothing is. Weights must be such that a score fits a long.
    """
    def usable(df: DataFrame) -> DataFrame:
        return df.select("vec_id", "weights").where("vec_id IS NOT NULL AND weights IS NOT NULL")

    rows, queries = usable(rows), usable(queries)
    n_rows, n_queries = rows.count(), queries.count()
    row_blocks, query_blocks = -(-n_rows // row_block) or 1, -(-n_queries // query_block) or 1
    block = lambda n: F.pmod(F.xxhash64("vec_id", "weights"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("_q", block(query_blocks)).withColumn("_r", spread(row_blocks))
    right = rows.withColumn("_r", block(row_blocks)).withColumn("_q", spread(query_blocks))

    def meet(key: tuple, some: pa.Table, all_rows: pa.Table) -> pa.Table:
        out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not some.num_rows or not all_rows.num_rows:
            return out.empty_table()
        found = best_of_block(
            some["vec_id"].to_numpy(), _vectors(some["weights"]),
            all_rows["vec_id"].to_numpy(), _vectors(all_rows["weights"]), k)
        return pa.table(dict(zip(out.names, found)), schema=out)

    best = left.groupBy("_q", "_r").cogroup(right.groupBy("_q", "_r")).applyInArrow(
        meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
