"""Exact nearest vectors by inner product with a vector-approximation file.

Vectors are quantised to cells of a byte for each component. The cells alone bound each score from
above and below, so a scan of the cells names, for each query, the few vectors whose upper bound
reaches the kth lower bound. Exact vectors are then read in the order of their bounds until no
unread one can still be among the first k.

The table is dealt out in blocks of ``BLOCK`` vectors. Queries, a stated set, are sent to each
block in groups as large; a block keeps for each query only what may be in its first k, and what is left
over all blocks is a small multiple of k. No pair of single vectors is ever a row before that.

Defined results: vectors that are null, of another length than most, or hold a null or non-finite
component take no part; equal scores go to the smaller id; a query never meets its own id, so
further rows with the same id are left out with it; fewer candidates than k are all returned.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tonewright.sources.workspace import materialize

BLOCK = 4096
GROUP = 512
CELLS = 256


def integer_vector(vector: Column) -> Column:
    """floor(64 x) of each component, or null if the vector takes no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(64 * x.cast("double")).cast("bigint"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & sound, whole)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def quantise(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells and, for each component, the lowest value and the width of a cell in this block."""
    low, high = exact.min(axis=0), exact.max(axis=0)
    width = np.maximum(1, -(-(high - low + 1) // CELLS))
    return ((exact - low) // width).astype(np.uint8), low, width


def bounds(
    queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of each score from the cells alone (doubles, rounded outwards)."""
    q = queries.astype(np.float64)
    base = cells.astype(np.float64) * width + low
    lower = q @ base.T
    slack = (width - 1).astype(np.float64)
    up = np.maximum(q, 0) @ slack
    down = np.minimum(q, 0) @ slack
    error = np.abs(q).sum(axis=1) * (np.abs(base).max(initial=0) + slack.max(initial=0)) * 1e-12
    return lower + (down - error)[:, None], lower + (up + error)[:, None]


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return vectors @ query


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, exact: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query rows, candidate rows and scores of each query's first k in a block."""
    cells, low, width = quantise(exact)
    lower, upper = bounds(queries, cells, low, width)
    own = query_ids[:, None] == ids[None, :]
    lower[own], upper[own] = -np.inf, -np.inf
    take = min(k, len(ids))
    sure = -np.partition(-lower, take - 1, axis=1)[:, take - 1]
    out_q, out_c, out_s = [], [], []
    for row in range(len(queries)):
        near = np.flatnonzero((upper[row] >= sure[row]) & ~own[row])
        near = near[np.argsort(-upper[row, near], kind="stable")]
        found = np.empty(0, dtype=np.int64)
        done = 0
        while done < len(near):
            part = near[done : done + max(k, 64)]
            found = np.concatenate([found, exact_scores(queries[row], exact[part])])
            done += len(part)
            if done < len(near) and len(found) >= k:
                kth = -np.partition(-found, k - 1)[k - 1]
                if upper[row, near[done]] < kth:
                    break
        best = np.lexsort((ids[near[:done]], -found))[:k]
        out_q.append(np.full(len(best), row))
        out_c.append(near[best])
        out_s.append(found[best])
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s)


def _search(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """All groups of queries that came to a block, against the block."""
    queries, members = left, right
    if not members.num_rows or not queries.num_rows:
        return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
    ids = members.column("vec_id").to_numpy()
    exact = _matrix(members.column("whole"))
    asked = queries.column("query_id").to_numpy()
    vectors = _matrix(queries.column("asked"))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for begin in range(0, len(asked), GROUP):
        part = slice(begin, begin + GROUP)
        q, c, s = search_block(asked[part], vectors[part], ids, exact, k)
        out.append((asked[part][q], ids[c], s))
    return pa.table(
        {
            name: pa.array(np.concatenate([x[i] for x in out]), pa.int64())
            for i, name in enumerate(("query_id", "vec_id", "score"))
        }
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k highest scores of each query.

    ``vectors`` has ``vec_id`` and ``embedding``. Blocks are dealt out by a hash of id and vector,
    so no id and no group of equal vectors makes a block large.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), integer_vector(F.col("embedding")).alias("whole")
    ).where("vec_id IS NOT NULL AND whole IS NOT NULL")
    stored = materialize(rows, "vectors")
    sizes = stored.groupBy(F.size("whole").alias("size")).count().orderBy(F.desc("count"), "size").first()
    spark = vectors.sparkSession
    if sizes is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    stored = stored.where(F.size("whole") == sizes["size"])
    asked = stored.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("whole").alias("asked"))
    asked = materialize(asked.distinct(), "queries")
    blocks, groups = -(-sizes["count"] // BLOCK), -(-asked.count() // BLOCK)
    if not groups:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # every group of queries meets every block of vectors: a cell holds at most a few thousand of each
    members = stored.withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "whole", F.monotonically_increasing_id()), F.lit(blocks))
    ).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    sent = asked.withColumn("group", F.pmod(F.xxhash64("query_id", "asked"), F.lit(groups)).cast("int"))
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    near = sent.groupBy("block", "group").cogroup(members.groupBy("block", "group")).applyInArrow(
        partial(_search, k=k), "query_id bigint, vec_id bigint, score bigint"
    )
    # ranks beyond k are dropped before the exchange, so blocks send k rows for a query at most
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
