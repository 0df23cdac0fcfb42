"""Exact top-k search by tiled matrix products.

Queries and candidates are dealt into blocks by hash. Each pair of blocks is a tile: one matrix product, from
which every query keeps its best ``k``. The partial lists are merged as a tree: within a group of tiles
first, then over the groups. A task holds one tile, of a size set by parameters, whatever the tables hold.

A product of ``q`` query blocks and ``c`` candidate blocks moves the queries ``c`` times and the candidates
``q`` times, so blocks should be as large as a task's memory allows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of queries and of candidates.
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 4096
#: Sums of products up to this size are exact in double precision.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def scaled(vector: str = "embedding", factor: int = 256):
    """The components times ``factor``, rounded down, as long numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def usable(vector: str):
    """Whether a vector and all its components are there and finite."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; beyond 64 bits they stay at the largest long number."""
    bound = float(np.abs(left.astype(float)).max(initial=0)) * float(np.abs(right.astype(float)).max(initial=0))
    if bound * max(left.shape[1], 1) < _EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -_LONG, _LONG).astype(np.int64)


def _tile(key: tuple, left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    ids, others = (t.column("id").to_numpy() for t in (left, right))
    width = key[2].as_py()
    rows = [np.array(t.column("vector").to_pylist(), np.int64).reshape(t.num_rows, width) for t in (left, right)]
    keys = left.column("query_key").to_numpy()
    out: list[list[np.ndarray]] = [[], [], [], []]
    order = np.argsort(others, kind="stable")
    others = others[order]
    for start in range(0, len(ids), 256):
        part = scores(rows[0][start : start + 256], rows[1][order]) if len(others) else np.zeros((0, 0), np.int64)
        for row in range(len(part)):
            allowed = np.flatnonzero(others != ids[start + row])
            got = part[row, allowed]
            if len(got) > k:
                least = np.partition(got, len(got) - k)[len(got) - k]
                # All at the border stay until the ids decide.
                near = np.flatnonzero(got >= least)
                allowed, got = allowed[near], got[near]
            best = np.lexsort((others[allowed], -got))[:k]
            out[0].append(np.full(len(best), ids[start + row]))
            out[1].append(np.full(len(best), keys[start + row]))
            out[2].append(others[allowed[best]])
            out[3].append(got[best])
    columns = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
    return pa.table(columns, names=["query_id", "query_key", "id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), id, score: each query's ``k`` best candidates, all if there are fewer.

    Both tables have ``id`` long and ``vector`` array of long; score is the integer inner product, ties go to
    the smaller id. A row is no candidate of a query with its own id. Vectors meet only vectors of their
    length; null ids take no part. Repeated rows with equal id and vector count once; a query id with several
    vectors gets a list for each. Without candidates a query has no rows.
    """
    vectors, queries = (
        t.filter("id IS NOT NULL AND vector IS NOT NULL")
        .select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<long>").alias("vector"))
        .withColumn("query_key", F.xxhash64("vector"))
        .dropDuplicates(["id", "query_key"])
        for t in (vectors, queries)
    )
    n_queries, n_vectors = queries.count(), vectors.count()
    q_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    c_blocks = max(1, -(-n_vectors // CANDIDATE_BLOCK))

    def dealt(table: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        return table.select(
            "id",
            "vector",
            "query_key",
            F.size("vector").alias("width"),
            F.pmod(F.xxhash64("id", "query_key"), F.lit(own_blocks)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))).alias(other),
        )

    place = ["q_block", "c_block", "width"]
    left = dealt(queries, "q_block", q_blocks, "c_block", c_blocks)
    right = dealt(vectors, "c_block", c_blocks, "q_block", q_blocks)
    tiles = (
        left.groupBy(*place)
        .cogroup(right.groupBy(*place))
        .applyInArrow(partial(_tile, k=k), "query_id long, query_key long, id long, score long")
    )
    order = [F.desc("score"), F.asc("id")]
    branch = max(1, round(c_blocks**0.5))
    partial_lists = tiles.withColumn("branch", F.pmod(F.xxhash64("id"), F.lit(branch)))
    for keys in (["query_id", "query_key", "branch"], ["query_id", "query_key"]):
        partial_lists = partial_lists.withColumn(
            "rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ).filter(F.col("rank") <= k)
    return partial_lists.select("query_id", "rank", "id", "score")
