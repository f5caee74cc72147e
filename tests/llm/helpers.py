"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, texts: list, first: int = 0) -> DataFrame:
    rows = [(first + i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed: int, n_words: int, vocabulary: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n_words))


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls, empty and very long texts, repeats, ties, and columns with clashing names."""
    long = prose(1, 30_000)
    texts = [None, "", "   ", "one", "One", long, long, "a b c d e", "a b  c d e", "ﬀ é 漢字 \U0001f600", "\x00\x1f", "x" * 5000]
    rows = [(i, t, None if i % 2 else "en", "s", None) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id", "en", None, 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "_key", "_hash", "_text", "component", "digest", "key", "tokens", "start", "node", "rep", "mark", "block"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
