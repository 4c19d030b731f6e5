"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barhouse.llm import (
    cross_align,
    exact_dedup,
    html_text,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    permutation_index,
    pii,
    quality,
    simhash,
    suffix_dedup,
    topk,
)
from barhouse.llm.common import Scratch, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [f"n_{k}" for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("text_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.digests(periodic_runs.periodic_runs(docs, reorder=periodic_runs.repeated_tail))


def op12_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = F.col("groups")
    digest = F.when(groups == "", "").otherwise(F.sha2(groups, 256)).alias("groups_sha256")
    aligned = cross_align.align(table(spark, sf_dir, "documents"))
    scratch = Scratch(spark)
    aligned = scratch.keep(aligned.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "links"))
    return cross_align.link_statistics(aligned, scratch)


def op13_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_html_text,
        op3_pii_spans,
        op4_line_dedup,
        op5_best_fit_packing,
        op6_simhash_dedup,
        op7_quality_resampling,
        op8_source_mixing,
        op9_exact_topk,
        op10_exact_dedup,
        op11_periodic_runs,
        op12_cross_align,
        op13_permutation_index,
    )
}

ORACLES: dict[str, str] = {
    "op8_source_mixing": mixing.ORACLE,
    "op9_exact_topk": topk.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
}
