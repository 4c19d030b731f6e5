"""Approximate nearest neighbours by a permutation index: pivot orders, inverted files, footrule, reranking.

A vector is represented by its nearest pivots in order of distance. Each shard of the index keeps one
inverted file per pivot with the vectors that have it among their nearest, and at which place. A query
reads the files of its own nearest pivots only, which gives the footrule distance of its order to the
orders of the shard's vectors; the best of these are compared with the query itself.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch

K = 20
QUERY_EVERY = 20
#: Pivots: a sample of the rows by a hash of the id, fit once for each length of vectors.
PIVOTS = 512
#: Pivots that represent a vector, or a query.
PREFIX = 64
#: Vectors of a shard, and queries that meet it at a time.
SHARD = 8192
ROUND = 16_384
#: Queries that are compared with every row, to fit how many candidates are compared again.
FIT_QUERIES = 128
#: The share of these queries' true neighbours that has to be among the candidates.
FIT_RECALL = 0.97


def usable_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, v array<double>, dim, norm): one row per id that takes part.

    A vector that is null, empty, zero, or holds a null or a non-finite component takes no part, nor does a
    row without an id. Repeated rows count once; of rows that share an id but not the vector, the smallest
    vector counts. Repeats are merged before the shuffle, so an id may be on any number of rows.
    """
    x = F.col("embedding")
    # The largest component is taken out of the squares, which might overflow.
    norm = F.col("high") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + (c / F.col("high")) * (c / F.col("high"))))
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return (
        df.where(F.col("vec_id").isNotNull() & x.isNotNull())
        .where(finite & F.exists(x, lambda c: c != 0))
        .select(F.col("vec_id").cast("long"), x.cast("array<double>").alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
        .withColumns({"dim": F.size("v"), "high": F.array_max(F.transform("v", F.abs))})
        .withColumn("norm", norm)
        .drop("high")
    )


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(rows, -1)


class Pivots:
    """Pivot vectors with one more component, which makes the largest inner product the smallest distance.

    Vectors get the component that brings all of them to the length ``most`` of the longest; queries are
    brought to that length and get zero (Neyshabur and Srebro 2015).
    """

    def __init__(self, vectors: np.ndarray, most: float, prefix: int):
        self.most = most
        self.prefix = min(prefix, len(vectors))
        self.vectors = self.lifted(vectors)

    def lifted(self, v: np.ndarray) -> np.ndarray:
        unit = v / self.most
        rest = np.maximum(1.0 - (unit * unit).sum(axis=1), 0.0)
        return np.hstack([unit, np.sqrt(rest)[:, None]])

    def lifted_queries(self, v: np.ndarray) -> np.ndarray:
        unit = v / np.abs(v).max(axis=1)[:, None]
        return np.hstack([unit / np.sqrt((unit * unit).sum(axis=1))[:, None], np.zeros((len(v), 1))])

    def order(self, lifted: np.ndarray) -> np.ndarray:
        """The nearest pivots of each row, nearest first; all lifted vectors are of one length."""
        near = lifted @ self.vectors.T
        if self.prefix < near.shape[1]:
            some = np.argpartition(-near, self.prefix - 1, axis=1)[:, : self.prefix]
        else:
            some = np.tile(np.arange(near.shape[1]), (len(near), 1))
        by_distance = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
        return np.take_along_axis(some, by_distance, axis=1)


_INDEX = "shard long, size long, ids binary, vectors binary, starts binary, members binary, places binary"


def _build(pivots: Pivots):
    """One shard: its vectors by id, and for each pivot the vectors that have it, and at which place."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows["vec_id"].to_numpy()
        by_id = np.argsort(ids)
        vectors = _matrix(rows["v"], len(ids))[by_id]
        order = pivots.order(pivots.lifted(vectors))
        pivot = order.ravel()
        by_pivot = np.argsort(pivot, kind="stable")
        starts = np.append(0, np.cumsum(np.bincount(pivot, minlength=len(pivots.vectors))))
        columns = [
            pa.array([key[0].as_py()], pa.int64()), pa.array([len(ids)], pa.int64()),
            *[
                pa.array([c.tobytes()], pa.binary())
                for c in (
                    ids[by_id], vectors, starts.astype(np.int64), (by_pivot // pivots.prefix).astype(np.int32),
                    (by_pivot % pivots.prefix).astype(np.int16),
                )
            ],
        ]
        return pa.Table.from_arrays(columns, names=[c.split()[0] for c in _INDEX.split(", ")])

    return run


class Shard:
    """A row of the index."""

    def __init__(self, row: pa.Table, pivots: Pivots):
        def column(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(row[name][0].as_py(), dtype=kind)

        self.pivots, self.ids = pivots, column("ids", np.int64)
        self.vectors = column("vectors", np.float64).reshape(len(self.ids), -1)
        self.starts, self.members = column("starts", np.int64).tolist(), column("members", np.int32)
        self.places = column("places", np.int16).astype(np.int64)

    def nearness(self, order: list[int]) -> np.ndarray:
        """How much less than its largest value the footrule distance to each vector is, halved.

        A pivot that is missing counts as standing right behind the last place, ``m``. Both orders then differ
        by m (m + 1) less 2 (m - max(i, j)) for each pivot that has place i here and j there.
        """
        m = self.pivots.prefix
        members, gains = [], []
        for i, pivot in enumerate(order):
            a, b = self.starts[pivot], self.starts[pivot + 1]
            members.append(self.members[a:b])
            gains.append(m - np.maximum(self.places[a:b], i))
        gain = np.bincount(np.concatenate(members), weights=np.concatenate(gains), minlength=len(self.ids))
        return gain.astype(np.int64)

    def best_first(self, order: list[int]) -> np.ndarray:
        """Distinct keys, the larger the nearer by footrule; ties to the smaller id."""
        n = len(self.ids)
        return self.nearness(order) * n + np.arange(n - 1, -1, -1)

    def scores(self, query: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        """Inner products, each summed in the same order wherever its vector stands."""
        return (self.vectors[rows] * query).sum(axis=1)


def _nearest(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id; ids are sorted."""
    if len(ids) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("share", pa.float64())])


def _tile(pivots: Pivots, k: int, share: float | None):
    """The k nearest of a shard to each query of a round, among the share of it that is nearest by footrule.

    Without ``share`` all rows are compared, and the share that each result would have needed is told.
    """

    def run(key: tuple, queries: pa.Table, index: pa.Table) -> pa.Table:
        if not queries.num_rows or not index.num_rows:
            return _FOUND.empty_table()
        shard, q_ids = Shard(index, pivots), queries["vec_id"].to_numpy()
        vectors = _matrix(queries["v"], len(q_ids))
        orders = pivots.order(pivots.lifted_queries(vectors)).tolist()
        size = len(shard.ids)
        wanted = size if share is None else min(size, max(k + 1, math.ceil(share * size)))
        found = []
        for q_id, query, order in zip(q_ids.tolist(), vectors, orders):
            keys = shard.best_first(order)
            rows = np.arange(size)
            if wanted < size:
                rows = np.sort(np.argpartition(keys, size - wanted)[size - wanted :])
            rows = rows[shard.ids[rows] != q_id]
            scores = shard.scores(query, rows)
            best = _nearest(shard.ids[rows], scores, k)
            needed = np.zeros(len(best))
            if share is None:
                needed = (size - np.searchsorted(np.sort(keys), keys[rows[best]])) / size
            found.append((np.full(len(best), q_id), shard.ids[rows[best]], scores[best], needed))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=_FOUND)

    return run


class PermutationIndex:
    """The index over vectors of one length, written to the shared scratch folder.

    Every vector is indexed. Fitted on bounded samples are the pivots (``PIVOTS`` rows) and the share of a
    shard that is compared again (``FIT_QUERIES`` queries against all rows); both samples and the fitted
    share are kept on the driver. ``vectors`` has vec_id and v, one row per id.
    """

    def __init__(self, vectors: DataFrame, scratch: Scratch, n: int, most: float, k: int = K):
        self.vectors, self.k = vectors, k
        self.shards = max(1, -(-n // SHARD))
        sample = vectors.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(PIVOTS).select("v").collect()
        self.pivots = Pivots(np.array([r.v for r in sample], dtype=np.float64), most, PREFIX)
        dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(self.shards)))
        self.index = scratch.keep(dealt.groupBy("shard").applyInArrow(_build(self.pivots), _INDEX))
        self.share = 1.0

    def _tiles(self, queries: DataFrame, rounds: int, share: float | None) -> DataFrame:
        def every(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

        dealt = queries.select(
            F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(rounds)).alias("round"), every(self.shards).alias("shard"), "vec_id", "v"
        )
        # Own names for the keys of the index: a column may not stand on both sides.
        index = self.index.select(every(rounds).alias("round_i"), F.col("shard").alias("shard_i"), "*").drop("shard")
        tiles = dealt.groupBy("round", "shard").cogroup(index.groupBy("round_i", "shard_i"))
        return tiles.applyInArrow(
            _tile(self.pivots, self.k, share), "query_id long, vec_id long, score double, share double"
        )

    def _first(self, found: DataFrame) -> DataFrame:
        nearest_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
        return found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= self.k)

    def fit_share(self, queries: DataFrame, count: int = FIT_QUERIES, recall: float = FIT_RECALL) -> float:
        """The share of each shard that holds ``recall`` of the true neighbours of ``count`` queries."""
        sample = queries.orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(count)
        true = self._first(self._tiles(sample, 1, None)).agg(F.percentile("share", F.lit(recall))).first()[0]
        self.share = 1.0 if true is None else float(true)
        return self.share

    def search(self, queries: DataFrame, n_queries: int) -> DataFrame:
        """(query_id, rank, vec_id, score): the nearest found to each query, which is no neighbour of its own."""
        found = self._tiles(queries, max(1, -(-n_queries // ROUND)), self.share)
        return self._first(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(df: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose id ``every`` divides.

    Nearest has the largest inner product in double precision; ties go to the smaller id, and a query is no
    neighbour of its own. There are k rows per query, or all others where they are fewer. Vectors are
    compared with those of their own length only, each length with an index of its own; see
    ``usable_vectors`` for rows that take no part. An empty table gives no rows. Other columns are ignored.

    Shards and rounds are groups of a stated size by a hash of the id. A shard goes to every round of
    ``ROUND`` queries, and nothing but k rows per query and shard comes back. The driver holds the pivots
    (``PIVOTS`` vectors), which also travel with the tasks.
    """
    scratch = Scratch(df.sparkSession)
    vectors = scratch.keep(usable_vectors(df))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    lengths = vectors.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max("norm").alias("most"))
    result = None
    for dim, n, n_queries, most in lengths.where("q > 0").orderBy("dim").collect():
        own = vectors.where(F.col("dim") == dim).select("vec_id", "v")
        index = PermutationIndex(own, scratch, n, most, k)
        queries = own.where(is_query)
        index.fit_share(queries)
        found = index.search(queries, n_queries)
        result = found if result is None else result.unionByName(found)
    if result is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return result
