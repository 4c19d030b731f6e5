"""What several operators of this package share: reading, scratch tables, packed rows."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barhouse.plans.scratch import drop_path, materialise, new_folder

#: ASCII white space as the contracts define it, for Java, DuckDB and Python patterns.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables of one run in the shared checkpoint folder, each removable by itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.count = spark, new_folder(spark), 0

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        self.count += 1
        path = f"{self.root}/t{self.count}"
        return materialise(df, path), path

    def keep(self, df: DataFrame) -> DataFrame:
        return self.write(df)[0]

    def drop(self, path: str) -> None:
        drop_path(self.spark, path)


def shuffle_width(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held(name: str, make: Callable[[], object]):
    """What ``make`` builds, once per process: the tasks that a Python worker runs after one another share it."""
    store = sys.modules.setdefault("barhouse_held", ModuleType("barhouse_held"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts with at most ``most`` bytes of text in ``column``, or one row with more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(int(np.searchsorted(ends, before + most, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def word_lists(texts: pa.Array) -> tuple[pa.ListArray, np.ndarray, pa.Array]:
    """Lists of words between ASCII white space (one empty word where there is none), where each list starts
    among all words, and all words."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    lists = pc.ascii_split_whitespace(trimmed)
    counts = np.where(pc.equal(trimmed, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(lists).to_numpy())
    flat = lists.flatten()
    if len(flat) != counts.sum():
        flat = flat.filter(pc.not_equal(flat, ""))  # a text without words is split into one empty word
    return lists, np.append(0, np.cumsum(counts)).astype(np.int64), flat


def blobs(owner: np.ndarray, n: int, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Per owner from 0 to n - 1 that occurs: the bytes of its part of each column, in order."""
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(np.bincount(owner, minlength=n))
    sorted_columns = [c[order] for c in columns]
    start = 0
    for k, end in enumerate(ends.tolist()):
        if end > start:
            yield k, [c[start:end].tobytes() for c in sorted_columns]
        start = end


def smallest_label(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 and links a-b: the smallest node reachable from each."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        open_ = label[a] != label[b]
        if not open_.any() and (label == label[label]).all():
            break
        if not open_.any():
            continue
    while (label != label[label]).any():
        label = label[label]
    return label


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``links`` (u, v: long) as (node, component): the smallest node reachable.

    Large-star and small-star rounds (Kiveris et al. 2014): every round is two
    joins on a node with its smallest neighbour, which is pre-aggregated, so a
    node with very many links is split like any skewed join. Every round is
    written down; none reaches the driver but a count and a checksum.
    """

    def stars(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("u", "v")
        if large:
            both = both.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low, path = scratch.write(both.groupBy("u").agg(F.min("v").alias("m")))
        low = low.select("u", F.least("u", "m").alias("m"))
        near = both.join(low, "u")
        if large:
            out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                low.select("u", F.col("m").alias("v"))
            )
        done, at = scratch.write(out.where("u <> v").distinct())
        scratch.drop(path)
        return done, at

    def sign(edges: DataFrame) -> tuple:
        found = edges.agg(
            F.count("*"), F.sum(F.xxhash64(F.least("u", "v"), F.greatest("u", "v")).cast("decimal(38,0)"))
        ).first()
        return tuple(found)

    edges, path = scratch.write(links.where("u <> v").distinct())
    before = sign(edges)
    while before[0]:
        wide, at = stars(edges, large=True)
        scratch.drop(path)
        edges, path = stars(wide, large=False)
        scratch.drop(at)
        now = sign(edges)
        if now == before:
            break
        before = now
    return edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("component"))
