"""Exact top-k search by inner product: tiles of queries and shards, and a tree of merges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch

K = 10
#: Components are floor(SCALE * x).
SCALE = 1024
QUERY_EVERY = 100
#: Vectors of a query block and of a shard; a task multiplies one of each.
QUERY_BLOCK = 1024
SHARD = 4096
#: Partial lists per query that one merge takes in.
FAN_IN = 16
_STRIP = 256

_TOP = pa.schema([("query_id", pa.int64()), ("shard", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def whole_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, v array<long>, dim): usable vectors, scaled to whole numbers, one per id.

    A vector that is null or holds a null or a non-finite component is left out,
    and so is a row without an id. Repeated rows count once; of rows that share an
    id but not the vector, the smallest vector counts.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return (
        df.where(F.col("vec_id").isNotNull() & x.isNotNull())
        .where(finite)
        .select(
            F.col("vec_id").cast("long"), F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE)))).alias("v")
        )
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
        .withColumn("dim", F.size("v"))
    )


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy()
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number products: by floating point where every sum fits its 53 bits, else by integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _tile(k: int):
    """The k best rows of a shard for each query of a block; fewer where the shard has fewer."""

    def run(key: tuple, queries: pa.Table, shard: pa.Table) -> pa.Table:
        if not queries.num_rows or not shard.num_rows:
            return _TOP.empty_table()
        q_ids, c_ids = queries["vec_id"].to_numpy(), shard["id_c"].to_numpy()
        q, c = _matrix(queries["v"], len(q_ids)), _matrix(shard["c"], len(c_ids))
        order = np.argsort(c_ids)
        c_ids, c = c_ids[order], c[order]
        found = []
        for a in range(0, len(q_ids), _STRIP):
            ids = q_ids[a : a + _STRIP]
            score = _products(q[a : a + _STRIP], c)
            own = np.minimum(np.searchsorted(c_ids, ids), len(c_ids) - 1)
            usable = np.ones(score.shape, dtype=bool)
            usable[np.arange(len(ids)), own] = c_ids[own] != ids
            if len(c_ids) > k + 1:  # one place more than wanted, as the query itself may be among them
                usable &= score >= np.partition(score, -(k + 1), axis=1)[:, [-(k + 1)]]
            row, col = np.nonzero(usable)
            best = np.lexsort((col, -score[row, col], row))
            row, col = row[best], col[best]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            row, col = row[rank < k], col[rank < k]
            found.append((ids[row], c_ids[col], score[row, col]))
        query, vec, score = (np.concatenate(x) for x in zip(*found))
        part = np.full(len(query), key[2].as_py(), dtype=np.int64)
        return pa.Table.from_arrays([pa.array(x) for x in (query, part, vec, score)], schema=_TOP)

    return run


def top_k(df: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest score for each row whose id ``every`` divides.

    Queries are dealt into blocks and all rows into shards by a hash of the id;
    a block meets a shard in a tile, a group of bounded size that one task
    multiplies as matrices. A tile gives k rows per query at most, and lists of
    one query are merged ``FAN_IN`` at a time until one is left. A copy of a shard
    goes to every query block, as the products are asked for; nothing is broadcast.

    Ties go to the smaller id; a query is no candidate of its own. Vectors are
    compared with those of their own length only; see ``whole_vectors`` for rows
    that take no part. Sums beyond 64 bits wrap around. Other columns are ignored.
    """
    vectors = Scratch(df.sparkSession).keep(whole_vectors(df))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, n_queries = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-n_queries // QUERY_BLOCK))

    def dealt(salt: int, parts: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts))

    def copies(parts: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    queries = vectors.where(is_query).select(
        "dim", dealt(1, blocks).alias("block"), copies(shards).alias("shard"), "vec_id", "v"
    )
    # Own names for every column: both sides come from one table.
    rows = vectors.select(
        F.col("dim").alias("dim_c"),
        copies(blocks).alias("block_c"),
        dealt(2, shards).alias("shard_c"),
        F.col("vec_id").alias("id_c"),
        F.col("v").alias("c"),
    )
    best = (
        queries.groupBy("dim", "block", "shard")
        .cogroup(rows.groupBy("dim_c", "block_c", "shard_c"))
        .applyInArrow(_tile(k), "query_id long, shard long, vec_id long, score long")
    )
    first = F.row_number().over(
        Window.partitionBy("query_id", "shard").orderBy(F.col("score").desc(), F.col("vec_id"))
    )
    while True:
        shards = -(-shards // FAN_IN)
        best = best.withColumn("shard", F.floor(F.col("shard") / FAN_IN)).withColumn("rank", first)
        best = best.where(F.col("rank") <= k)
        if shards == 1:
            return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = f"""
WITH t AS (
  SELECT vec_id, min([floor({SCALE} * x::DOUBLE) FOR x IN embedding]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
  GROUP BY vec_id
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM t q JOIN t c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
