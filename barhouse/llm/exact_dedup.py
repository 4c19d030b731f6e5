"""Exact duplicates: group by a 128-bit content hash, keep the smallest id, compare bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barhouse.llm.common import SPACE, Scratch


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one blank; a null text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def exact_groups(
    docs: DataFrame, content_hash: Callable[[Column], Column] = md5_128
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``.

    The hash and the text itself are the grouping key, so texts are compared
    byte by byte within a hash, and equal texts are merged before the shuffle: a
    text that fills a third of the table crosses it once per task. What is kept
    per hash holds no text. Rows find their group by the hash; only rows of a
    hash with several texts (a collision) are matched by the text as well.

    Null and empty texts are equal. An id that is null never becomes ``keep_id``
    unless its group has no other. Rows that repeat an id within a group are one
    document: both are kept or both dropped. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select("doc_id", normalised(F.col("text")).alias("body")).withColumn(
        "h", content_hash(F.col("body"))
    )
    texts = rows.groupBy("h", "body").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    hashes = scratch.keep(
        texts.groupBy("h").agg(
            F.count("*").alias("texts"),
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        )
    )
    # Rows meet their hash without their text.
    digests = rows.select("doc_id", "h", F.sha2("body", 256).alias("text_sha256"))
    found = digests.join(hashes.where("texts = 1").drop("texts"), "h")
    mixed = hashes.where("texts > 1").select("h")
    if not mixed.isEmpty():
        told_apart = rows.join(mixed, "h").join(texts, ["h", "body"])
        found = found.unionByName(
            told_apart.select("h", "doc_id", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
        )
    return found.select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; a repeated row stays once.

    Rows that share an id but differ in text are different documents.
    """
    stay = (
        exact_groups(docs)
        .where("kept")
        .select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_text"))
        .distinct()
    )
    hashed = docs.withColumn("_text_hash", F.sha2(normalised(docs["text"]), 256))
    same = hashed["doc_id"].eqNullSafe(stay["_kept_id"]) & (hashed["_text_hash"] == stay["_kept_text"])
    once = Window.partitionBy("doc_id", "_text_hash").orderBy("doc_id")
    return (
        hashed.join(stay, same, "left_semi")
        .withColumn("_turn", F.row_number().over(once))
        .where("_turn = 1")
        .drop("_turn", "_text_hash")
    )


ORACLE = rf"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[{SPACE}]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM t
"""
