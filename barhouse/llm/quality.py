"""Quality classifier by importance resampling: hashed n-gram models and Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch

#: Buckets of the hashed shape n-grams; two more count words that differ from the one before or repeat it.
BUCKETS = 1 << 16
GRAM = 4
#: The classifier is fitted on this many labelled rows at most (chosen by a hash of the id).
LABELLED_ROWS = 20_000
SEED = 11
#: Rows that the exact search for the k-th key looks at on the driver, at most.
_FINAL_ROWS = 10_000

#: Shape of a byte: letters of one case alike (bytes of non-ASCII letters count as small), digits
#: alike, white space alike, all else itself. Makes the models compare style, not language.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[9:14] = 32


def grams(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of a text: ``GRAM``-grams of its byte shapes, and its repeated words."""
    text = text or ""
    shape = _SHAPE[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)].astype(np.uint32)
    n = max(0, len(shape) - GRAM + 1)
    code = np.zeros(n, dtype=np.uint32)
    for i in range(GRAM):
        code |= shape[i : i + n] << np.uint32(8 * i)
    found = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    words = text.split()
    again = np.fromiter(map(eq, words, words[1:]), dtype=np.uint32, count=max(0, len(words) - 1))
    return np.concatenate([found, BUCKETS + again]).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task one row per bucket seen: n-grams in all texts, and in those of the target."""
    raw = np.zeros(BUCKETS + 2, dtype=np.int64)
    target = np.zeros_like(raw)
    for batch in batches:
        for text, wanted in zip(batch.column(0), batch.column(1)):
            counts = np.bincount(grams(text.as_py()), minlength=BUCKETS + 2)
            raw += counts
            if wanted.as_py():
                target += counts
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"]
    )


@dataclass(frozen=True)
class Model:
    """log p_target / p_raw per bucket, and the weight from which a text counts as target-like."""

    ratio: np.ndarray
    boundary: float

    def weight(self) -> Column | object:
        ratio = self.ratio

        @F.pandas_udf("double")
        def log_weight(texts: pd.Series) -> pd.Series:
            return pd.Series([float(ratio[grams(t)].sum()) for t in texts], dtype="float64")

        return log_weight


def _log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Add-one smoothed, one model for the shapes and one for word repetition."""
    out = np.zeros(BUCKETS + 2)
    for part in (slice(0, BUCKETS), slice(BUCKETS, None)):
        r, t = raw[part], target[part]
        out[part] = np.log((t + 1) / (t.sum() + len(t))) - np.log((r + 1) / (r.sum() + len(r)))
    return out


def _boundary(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that best parts good from bad labelled rows (equal weight to both classes)."""
    if not good.any() or good.all():
        return -math.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    score = np.append(0, np.cumsum(np.where(g, -1 / g.sum(), 1 / (~g).sum())))
    cut = np.flatnonzero(np.append(True, w[1:] > w[:-1]))  # a threshold falls between different weights
    best = cut[np.argmax(score[cut])]
    return float(w[best] if best == 0 else (w[best - 1] + w[best]) / 2)


def labelled_sample(labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """(label_id, good): at most ``rows`` labelled ids; a conflict between repeated labels counts as bad."""
    return (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg((F.min("quality") >= 1).alias("good"))
        .orderBy(F.xxhash64("label_id", F.lit(SEED)), "label_id")
        .limit(rows)
    )


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Model:
    """Count n-grams over every document; the target's over the good ones of the labelled sample.

    The broadcast sample has ``rows`` rows at most. Without any good labelled
    row the models are equal and every weight is 0.
    """
    scratch = Scratch(docs.sparkSession)
    sample = F.broadcast(scratch.keep(labelled_sample(labels, rows)))
    texts = docs.select("doc_id", F.col("text"))
    marked = texts.join(sample, texts["doc_id"] == sample["label_id"], "left")
    counts = (
        marked.select("text", F.coalesce("good", F.lit(False)).alias("good"))
        .mapInArrow(_count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw"), F.sum("target"))
        .collect()  # BUCKETS + 2 rows at most
    )
    raw = np.zeros(BUCKETS + 2, dtype=np.int64)
    target = np.zeros_like(raw)
    for bucket, r, t in counts:
        raw[bucket], target[bucket] = r, t
    if not target.any():
        return Model(np.zeros(BUCKETS + 2), -math.inf)
    ratio = _log_ratio(raw, target)
    weigh = Model(ratio, 0.0).weight()
    held = (
        texts.join(sample, texts["doc_id"] == sample["label_id"])
        .select(weigh("text"), "good")
        .collect()  # labelled rows only
    )
    weights = np.array([r[0] for r in held], dtype=float)
    return Model(ratio, _boundary(weights, np.array([r[1] for r in held], dtype=bool)))


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise, a fixed function of the id."""
    bits = F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest value of ``key``, exactly, by narrowing a histogram; -inf if there are fewer."""
    inside, above = keys.where("key is not null"), 0
    while True:
        n, low, high = inside.agg(F.count("*"), F.min("key"), F.max("key")).first()
        if n == 0 or k - above > n:
            return -math.inf
        if low == high:
            return low
        if n <= _FINAL_ROWS:
            return sorted((r[0] for r in inside.select("key").collect()), reverse=True)[k - above - 1]
        bin_ = F.least(F.lit(4095), F.floor((F.col("key") - low) / (high - low) * 4096))
        bins = inside.groupBy(bin_.alias("b")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        for b in sorted(bins.collect(), reverse=True):  # 4096 rows at most
            if above + b.n >= k:
                inside = inside.where(F.col("key").between(b.low, b.high))
                break
            above += b.n


@dataclass(frozen=True)
class Selection:
    model: Model
    weigh: object
    threshold: float

    def key(self, docs: DataFrame) -> Column:
        return self.weigh(docs["text"]) + gumbel(docs["doc_id"])


def select(docs: DataFrame, labels: DataFrame, k: int | None = None) -> tuple[Selection, DataFrame]:
    """Fit, weigh every row, and find the Gumbel top-k threshold. Also gives (doc_id, log_weight, key).

    ``k`` is by default the number of rows whose weight is at least the boundary
    learned from the labels. Null and empty texts have weight 0. Rows that tie at
    the threshold, such as repeated rows, stay together.
    """
    model = fit(docs, labels)
    weigh = model.weight()
    scored = Scratch(docs.sparkSession).keep(
        docs.select("doc_id", weigh("text").alias("log_weight")).withColumn(
            "key", F.col("log_weight") + gumbel(F.col("doc_id"))
        )
    )
    if k is None:
        k = scored.where(F.col("log_weight") >= F.lit(model.boundary)).count()
    threshold = kth_largest(scored, k) if k else math.inf
    return Selection(model, weigh, threshold), scored


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """(doc_id, log_weight, key, kept): importance resampling of ``docs`` towards well-labelled text.

    A row's log weight is the log ratio of two hashed n-gram models summed over
    its whole text; with Gumbel noise added, the k largest keys are a sample
    without replacement by weight. Every row gives one row. An empty table gives
    an empty result, and without labels all rows stay.
    """
    chosen, scored = select(docs, labels, k)
    return scored.withColumn("kept", F.col("key") >= F.lit(chosen.threshold))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; texts are weighed again, not joined."""
    chosen, _ = select(docs, labels)
    if chosen.threshold == -math.inf:
        return docs
    return docs.where(chosen.key(docs) >= F.lit(chosen.threshold))
