"""Mixing sources to target weights by capped water-filling. DataFrame and SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barhouse.llm.common import WORD, Scratch
from barhouse.operators.keys import assign_keys

#: Seeded order of the documents of a source: md5 of "seed:doc_id".
SEED = 7
#: Leading hex digits of that md5 that form a cell; a source has 16 ** 3 cells at most.
CELL_DIGITS = 3
_WHOLE = "decimal(38,0)"


@dataclass(frozen=True)
class Shares:
    """``weights`` repeat over the sources in their order; the mix holds ``budget_pct`` percent
    of all words; a source is used ``max_epochs`` times at most."""

    weights: Sequence[int] = (3, 1, 2)
    budget_pct: int = 150
    max_epochs: int = 2


def _level(sources: DataFrame, budget: int) -> tuple[int, int]:
    """Water level as (words left, weight left): an open source gets words * weight_of_it / weight.

    Each round caps the sources that the level would take over their limit and
    raises the level for the rest; it ends when none is over. A round is one
    aggregate; there are at most as many rounds as different limit-to-weight ratios.
    """
    left, weight = budget, sources.agg(F.sum("weight")).first()[0] or 0
    while weight:
        over = F.col("cap").cast(_WHOLE) * F.lit(weight) <= F.col("weight").cast(_WHOLE) * F.lit(left)
        capped, open_weight = sources.agg(
            F.sum(F.when(over, F.col("cap").cast(_WHOLE)).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
        ).first()
        now = (budget - int(capped or 0), int(open_weight or 0))
        if now == (left, weight):
            break
        left, weight = now
    return left, weight


def mix(docs: DataFrame, shares: Shares = Shares(), seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source): what the mix takes of each row.

    A source's target in words, rounded, is filled with whole repetitions of all
    its documents and then with one more of some: in the seeded order, until the
    target is reached, where the last one is cut. So a source's taken words equal
    its rounded target. No source is ordered as a whole: the order's leading
    digits cut it into cells, words are summed per cell (pre-aggregated), and only
    rows of one cell are ranked together. Rows never meet by source alone.

    Sizes count words, 0 for a null or empty text; such rows take 0. A null
    source is a source, the last one. Rows that repeat an id count each. An empty
    table gives an empty result. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(
        docs.select(
            "doc_id",
            "source",
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
            .alias("turn"),
        ).withColumn("cell", F.substring("turn", 1, CELL_DIGITS))
    )
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    sizes = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    key = F.struct(F.col("source").isNull().alias("last"), "source")
    none = docs.sparkSession.range(1).select(F.lit(0).alias("n"))
    ranked = assign_keys(sizes.withColumn("k", key), none, scratch.keep, "k", "source_no")
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in shares.weights]),
        F.pmod(F.col("source_no") - 1, F.lit(len(shares.weights))).cast("int") + 1,
    )
    sources = scratch.keep(
        ranked.select("source", "source_size", weight.alias("weight")).withColumn(
            "cap", F.col("source_size") * 100 * shares.max_epochs
        )
    )
    # In hundredths of a word, so that every comparison is between whole numbers.
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, weight_left = _level(sources, total * shares.budget_pct)
    over = F.col("cap").cast(_WHOLE) * F.lit(weight_left) <= F.col("weight").cast(_WHOLE) * F.lit(left)
    part = F.col("weight").cast(_WHOLE) * F.lit(left)
    targets = (
        sources.withColumn("over", over)
        .withColumn("part", part)
        .withColumn("share", F.lit(100 * weight_left).cast(_WHOLE))
        .withColumn("whole", F.col("source_size") * shares.max_epochs)
        .select(
            "source",
            "source_size",
            F.when(F.col("over"), F.col("whole").cast("double"))
            .otherwise(F.col("part").cast("double") / F.col("share").cast("double"))
            .alias("target"),
            F.when(F.col("over"), F.col("whole"))
            .otherwise(F.expr("(2 * part + share) div (2 * share)"))
            .alias("words"),
        )
        .withColumn("copies", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0))
    )
    before = (
        Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        cells.withColumn("before", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
        .join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select(
            F.col("source").alias("s"),
            F.col("cell").alias("c"),
            "source_size",
            "target",
            "copies",
            (F.col("words") - F.col("copies") * F.col("source_size") - F.col("before")).alias("room"),
        )
    )
    ahead = (
        Window.partitionBy("source", "cell")
        .orderBy("turn", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))
    ).withColumn("ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.col("ahead")))
    return placed.select(
        "doc_id",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        (F.col("copies") * F.col("size") + extra).cast("long").alias("taken"),
        "source",
    )


def mixed_documents(docs: DataFrame, shares: Shares = Shares(), seed: int = SEED) -> DataFrame:
    """``docs`` as mixed: a row per whole repetition, and one cut to the words of the last, partial one.

    ``n_chars`` of a cut row, where the table has it, is counted again. Rows that
    repeat an id share the least that one of them gets.
    """
    names = docs.columns
    taken = (
        mix(docs, shares, seed)
        .where("taken > 0")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("size").alias("_size"), F.min("taken").alias("_taken"))
    )
    rows = docs.join(taken, docs["doc_id"].eqNullSafe(taken["_id"]))
    times = F.ceil(F.col("_taken") / F.col("_size")).cast("int")
    rows = rows.withColumn("_turn", F.explode(F.sequence(F.lit(1), times)))
    words = F.least(F.col("_size"), F.col("_taken") - (F.col("_turn") - 1) * F.col("_size"))
    rows = rows.withColumn("_words", words)
    cut = F.array_join(
        F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("_words").cast("int")), " "
    )
    whole = F.col("_words") >= F.col("_size")
    rows = rows.withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
    if "n_chars" in names:
        rows = rows.withColumn(
            "n_chars", F.when(whole, F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
        )
    return rows.select(*names)


ORACLE = rf"""
WITH r AS (
  SELECT doc_id, source, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS turn,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS n FROM r GROUP BY source
), w AS (
  SELECT source, n, 200 * n AS cap,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS weight
  FROM s
), o AS (
  SELECT *, 150 * sum(n) OVER () - coalesce(sum(cap) OVER before, 0) AS lft,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS wt
  FROM w WINDOW before AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, cap * wt <= weight * lft AS over_cap FROM o
), l AS (
  SELECT 150 * (SELECT sum(n) FROM w) - coalesce(sum(cap) FILTER (over_cap), 0) AS lft,
         coalesce(sum(weight) FILTER (NOT over_cap), 0) AS wt FROM c
), t AS (
  SELECT source, n,
         CASE WHEN over_cap THEN (2 * n)::DOUBLE
              ELSE (weight * l.lft)::DOUBLE / (100 * l.wt)::DOUBLE END AS target,
         CASE WHEN over_cap THEN 2 * n
              ELSE (weight * l.lft + 50 * l.wt) // (100 * l.wt) END AS words
  FROM c, l
), a AS (
  SELECT r.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY turn, doc_id, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM r
)
SELECT doc_id, size, n::BIGINT AS source_size, target,
       CASE WHEN n = 0 THEN 0
            ELSE words // n * size + greatest(0, least(size, words - words // n * n - ahead))
       END::BIGINT AS taken, a.source
FROM a JOIN t ON a.source IS NOT DISTINCT FROM t.source
"""
