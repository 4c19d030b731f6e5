"""The training-data pipeline: quality, exact and near copies, source mix, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barhouse.llm import exact_dedup, mixing, packing, quality, simhash
from barhouse.llm.common import Scratch, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before kept, written as parquet in the shared folder and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs


#: SQL expresses neither the hashed n-gram models nor XXH64; tests hold the rows against brute force.
ORACLE_SQL = None
