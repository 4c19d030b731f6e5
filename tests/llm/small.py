"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i * 7919 % 5003}" for i in range(30_000))

AWKWARD = [
    (10, "alpha beta gamma delta epsilon zeta", "en", "b", 35),
    (3, "alpha  beta\tgamma delta\nepsilon zeta", "en", "a", 36),
    (7, None, "en", "a", None),
    (8, "", None, None, 0),
    (9, " \t\n ", "en", None, 4),
    (11, "One", "en", "b", 3),
    (12, "one two", "de", "", 7),
    (13, "One TWO", "de", "b", 7),
    (None, "alpha beta gamma delta epsilon zeta", "en", "c", 35),
    (None, "only without an id", None, "c", 18),
    (20, LONG, "en", "d", len(LONG)),
    (21, LONG + " tail", "en", "d", len(LONG) + 5),
    (30, "same row twice é\U0001f600", "fr", "b", 17),
    (30, "same row twice é\U0001f600", "fr", "b", 17),
    (31, "one id", "en", "b", 6),
    (31, "two texts", "en", "b", 9),
]


def docs(spark, rows=AWKWARD):
    return spark.createDataFrame(rows, SCHEMA)


def crowded(df):
    """``df`` with more columns, named like those that operators use inside or give out."""
    names = (
        "body h key kept keep_id group_size size target taken cell turn fp rep fingerprint component_id "
        "bin used offset piece log_weight good label_id host part slots blob line_no node u v rank score"
    ).split()
    return df.select("*", *[F.lit("x").alias(c) for c in names if c not in df.columns])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
