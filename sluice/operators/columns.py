"""Cleaning operators on a DataFrame: one column (or a few) replaced, rows untouched.

Operators that report a count return it as a number. It comes from one aggregate over
the column concerned. Pipelines use the flag expressions of
`sluice.functions.cleaning` instead and count all of them in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import cleaning as c


def count_where(df: DataFrame, condition: Column) -> int:
    return df.agg(F.count(F.when(condition, 1))).first()[0]


def strip_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim whitespace in the given text columns; blank text becomes null."""
    return df.withColumns({name: c.strip(F.col(name)) for name in columns})


def lowercase(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lower(column))


def uppercase(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.upper(column))


def parse_datetime(df: DataFrame, column: str, pattern: str | None = None) -> DataFrame:
    """Text to a zoneless timestamp; what does not parse becomes null."""
    return df.withColumn(column, c.to_datetime(F.col(column), pattern))


def cast_float(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Text to double: (df, how many values were lost)."""
    text, casted = F.col(column), c.to_double(F.col(column))
    return df.withColumn(column, casted), count_where(df, c.cast_failed(text, casted))


def cast_int(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Text to bigint: (df, how many values were lost)."""
    text, casted = F.col(column), c.to_bigint(F.col(column))
    return df.withColumn(column, casted), count_where(df, c.cast_failed(text, casted))


def nullify_outside_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> tuple[DataFrame, int]:
    """Null what lies outside inclusive bounds: (df, how many values were nulled)."""
    outside = c.outside_range(F.col(column), low, high)
    return (
        df.withColumn(column, F.when(~outside, F.col(column))),
        count_where(df, outside),
    )
