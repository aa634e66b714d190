"""Rows that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta river stone cloud ember quiet amber north south sail rope wind tide".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))


def rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, repeated rows and repeated ids."""
    same = prose(1, 60)
    return [
        (1, same, "en", "a", 1),
        (2, same, "en", "b", 1),
        (2, same, "en", "b", 1),
        (3, prose(2, 40), None, None, None),
        (4, None, "en", "a", None),
        (5, "", "en", None, 0),
        (6, " \t\n ", "en", "a", 4),
        (None, prose(3, 30), "en", "a", 1),
        (None, prose(4, 30), "en", "a", 1),
        (None, None, None, None, None),
        (7, prose(5, 30_000), "en", "c", 1),
        (7, prose(6, 50), "en", "c", 1),
        (8, "word", "en", "a", 4),
        (9, "x" * 5_000, "en", "a", 1),
    ]


def frame(spark, more: tuple[str, ...] = ()):
    """The rows, with extra string columns named ``more``."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows(), SCHEMA)
    for name in more:
        df = df.withColumn(name, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *columns):
    """Rows of a result as a sorted list."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
