"""Exploration: samples, first rows, distinct values and value frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.cleaning import trim


def sample(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """A random share of the rows, for looking at data. Not for referential checks:
    those need every parent row."""
    return df.sample(fraction=fraction, seed=seed)


def head(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """The first rows by a column that says their order; without one, any rows."""
    return df.limit(n) if order_by is None else df.orderBy(order_by).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The non-null values of a column, once each, in order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def value_counts(df: DataFrame, column: str, normalize_text: bool = False) -> DataFrame:
    """(column, count), most frequent first; null is a value like any other.

    With `normalize_text` values are trimmed and lowercased first.
    """
    value = F.lower(trim(F.col(column))) if normalize_text else F.col(column)
    return (
        df.select(value.alias(column))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.col(column))
    )
