"""Small tables with awkward rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["ka", "lo", "mi", "ren", "tas", "vu", "pel", "dro", "si", "gan", "fe", "zur"]


def sentence(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def text(rng: random.Random, sentences: int = 12) -> str:
    return "\n".join(sentence(rng, rng.randint(6, 12)) for _ in range(sentences))


def awkward(spark):
    """Nulls in every column, empty and blank texts, repeated rows, ties, a long text, and columns with clashing names."""
    rng = random.Random(3)
    a, b = text(rng), text(rng)
    rows = [(1, a, "en", "x", 5), (2, a, "en", "x", 5), (3, a.upper(), "en", "y", 5), (4, b, None, None, None),
            (4, b, None, None, None), (None, b, "en", "x", 1), (None, None, None, None, None), (5, None, "en", "x", 0),
            (6, "", "en", "y", 0), (7, " \n\t ", "en", "y", 4), (8, "one two", "fr", "x", 7), (9, text(rng, 3000), "en", "x", 1),
            (10, "word" * 30_000, "en", "z", 1), (11, "▁ odd  ☃ \U0001f600 ▁▁", "en", "z", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    clashing = ["row", "node", "copy", "position", "digest", "rank", "best", "score", "kept", "key", "part", "cdf", "ids"]
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clashing)])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
