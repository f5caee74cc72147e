"""Exact quantiles and quantile bins without gathering the values in one task.

An approximate quantile sketch brackets each quantile between two values. Only the
values inside the bracket are then ranked; the ones below are counted. The result is
the exact linearly interpolated quantile, not an approximation.
"""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.quality import count_true
from sluice.sources.staging import Staging

# Sketch ranks are off by at most 1 in ACCURACY. Brackets reach MARGIN to both sides, and
# ten times as far after each miss; from 1 on they span all values.
ACCURACY = 10_000
MARGIN = 4 / ACCURACY


def _brackets(
    df: DataFrame, columns: list[str], probabilities: list[float], margin: float
) -> tuple[dict[str, int], dict[tuple[str, int], tuple[float, float]]]:
    """Row counts per column, and per (column, quantile) a value below and one above."""
    points = [max(p - margin, 0.0) for p in probabilities]
    points += [min(p + margin, 1.0) for p in probabilities]
    row = df.agg(
        *(F.count(c).alias(f"n_{c}") for c in columns),
        *(F.percentile_approx(F.col(c).cast("double"), points, ACCURACY).alias(f"q_{c}") for c in columns),
    ).first()
    sizes = {c: row[f"n_{c}"] for c in columns}
    k = len(probabilities)
    bounds = {
        (c, i): (row[f"q_{c}"][i], row[f"q_{c}"][k + i])
        for c in columns
        if sizes[c]
        for i in range(k)
    }
    return sizes, bounds


def deal_by_rank(values: DataFrame, order: list[str], staging: Staging) -> DataFrame:
    """The rows in stretches that follow `order`, numbered in `stretch`, of about equal size.

    The borders are quantiles of a sample of the rows themselves, so that stretches are even
    however the values are spread. Stored, because another sample has other borders.
    """
    dealt = values.repartitionByRange(*order).withColumn("stretch", F.spark_partition_id())
    return staging.pin(dealt, "stretches")


def _ranked(
    df: DataFrame,
    bounds: dict[tuple[str, int], tuple[float, float]],
    positions: dict[tuple[str, int], int],
    staging: Staging,
) -> dict[tuple[str, int], tuple[float | None, float | None]]:
    """Per (column, quantile) the values at its position and at the next one."""
    below = df.agg(
        *(count_true(F.col(c) < low).alias(f"{c}_{i}") for (c, i), (low, _) in bounds.items())
    ).first()
    tagged = F.array_compact(
        F.array(
            *(
                F.when(
                    F.col(c).cast("double").between(low, high),
                    F.struct(
                        F.lit(c).alias("column"),
                        F.lit(i).alias("quantile"),
                        F.col(c).cast("double").alias("value"),
                        F.lit(positions[c, i] - below[f"{c}_{i}"]).cast("bigint").alias("position"),
                    ),
                )
                for (c, i), (low, high) in bounds.items()
            )
        )
    )
    # Equal values are counted, not repeated, before the brackets are ranked.
    values = (
        df.select(F.explode(tagged).alias("t"))
        .select("t.*")
        .groupBy("column", "quantile", "position", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    dealt = deal_by_rank(values, ["column", "quantile", "value"], staging)
    # A value's rank is counted within its stretch; what the stretches before hold is a
    # short table. So no task needs all values of a bracket.
    per_stretch = dealt.groupBy("column", "quantile", "stretch").agg(F.sum("n").alias("held"))
    in_order = Window.partitionBy("column", "quantile").orderBy("stretch")
    before = per_stretch.withColumn("before", F.sum("held").over(in_order) - F.col("held")).drop("held")
    upto = Window.partitionBy("column", "quantile", "stretch").orderBy("value")
    end = F.sum("n").over(upto) + F.col("before")
    placed = (
        dealt.join(F.broadcast(before), ["column", "quantile", "stretch"])
        .withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("n"))
    )

    def value_at(position: Column) -> Column:
        inside = (F.col("start") <= position) & (position < F.col("end"))
        return F.max(F.when(inside, F.col("value")))

    picked = placed.groupBy("column", "quantile").agg(
        value_at(F.col("position")).alias("low"), value_at(F.col("position") + 1).alias("high")
    )
    return {(r["column"], r["quantile"]): (r["low"], r["high"]) for r in picked.collect()}


def quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], staging: Staging | None = None
) -> dict[str, list[float]]:
    """Exact quantiles of numeric columns, interpolated linearly between neighbours.

    Reads `df` several times, so pass a stored or staged one. What reaches the driver
    is a few numbers per quantile. A column without values has no quantiles.
    """
    staging = staging or Staging(df.sparkSession)
    result: dict[tuple[str, int], float] = {}
    open_, margin = columns, MARGIN
    while open_:
        sizes, bounds = _brackets(df, open_, probabilities, margin)
        bounds = {key: b for key, b in bounds.items() if key not in result}
        exact = {(c, i): (sizes[c] - 1) * probabilities[i] for c, i in bounds}
        positions = {key: floor(p) for key, p in exact.items()}
        for key, (low, high) in _ranked(df, bounds, positions, staging).items() if bounds else ():
            fraction = exact[key] - positions[key]
            if low is not None and (fraction == 0 or high is not None):
                result[key] = low if fraction == 0 else low + (high - low) * fraction
        open_ = [c for c in open_ if any((c, i) in bounds and (c, i) not in result for i in range(len(probabilities)))]
        margin *= 10
    return {
        c: [result[c, i] for i in range(len(probabilities))] if (c, 0) in result else []
        for c in columns
    }


def cut_points(df: DataFrame, columns: list[str], bins: int, staging: Staging | None = None) -> DataFrame:
    """The inner bin edges of each column as a one-row frame of arrays."""
    edges = quantiles(df, columns, [i / bins for i in range(1, bins)], staging)
    schema = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in columns])
    return df.sparkSession.createDataFrame([tuple(edges[c] for c in columns)], schema)


def bin_number(value: Column, edges: Column, bins: int, descending: bool = False) -> Column:
    """1..bins by the number of edges below the value, so that equal values share a bin.

    Bins are open on the left and closed on the right. `descending` numbers them from
    the greatest values down.
    """
    above = F.lit(0)
    for i in range(bins - 1):
        above = above + F.when(value > F.get(edges, F.lit(i)), 1).otherwise(0)
    number = bins - above if descending else 1 + above
    return number.cast("tinyint")
