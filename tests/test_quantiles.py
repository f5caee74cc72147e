import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import quantiles as q

QUARTILES = [0.25, 0.5, 0.75]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 101, 5000])
def test_quantiles_equal_linear_interpolation(spark, n):
    generator = random.Random(n)
    rows = [(generator.randrange(5), generator.random() * 1000, i) for i in range(n)]
    df = spark.createDataFrame(rows, "ties bigint, spread double, line bigint").repartition(3)
    found = q.quantiles(df, ["ties", "spread", "line"], QUARTILES)
    for i, name in enumerate(("ties", "spread", "line")):
        expected = np.quantile([float(r[i]) for r in rows], QUARTILES)
        assert found[name] == pytest.approx(list(expected), rel=1e-12)


def test_many_rows_use_the_bracket(spark, monkeypatch):
    """Far more values than the sketch keeps, and no second pass over all of them."""
    passes = []
    ranked = q._ranked
    monkeypatch.setattr(q, "_ranked", lambda *a: passes.append(len(a[1])) or ranked(*a))
    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("x"))
    values = sorted(r.x for r in df.collect())
    assert q.quantiles(df, ["x"], QUARTILES)["x"] == pytest.approx(list(np.quantile(values, QUARTILES)))
    assert passes == [3]


def test_a_missed_bracket_is_widened(spark, monkeypatch):
    """Brackets that do not hold their quantile at first are searched again, ten times wider."""
    brackets, margins = q._brackets, []

    def missing_at_first(df, columns, probabilities, margin):
        margins.append(margin)
        shifted = [p / 2 for p in probabilities] if len(margins) < 3 else probabilities
        return brackets(df, columns, shifted, margin)

    monkeypatch.setattr(q, "_brackets", missing_at_first)
    df = spark.range(200_000).select(F.col("id").cast("double").alias("x"))
    assert q.quantiles(df, ["x"], QUARTILES)["x"] == [49999.75, 99999.5, 149999.25]
    assert len(margins) == 3 and margins[2] == pytest.approx(100 * margins[0])


def test_all_values_are_ranked_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(q, "MARGIN", 1.0)
    df = spark.range(5000).select((F.col("id") % 700).cast("double").alias("x"), F.lit(3.0).alias("same"))
    found = q.quantiles(df, ["x", "same"], QUARTILES)
    assert found["x"] == list(np.quantile([i % 700 for i in range(5000)], QUARTILES)) and found["same"] == [3.0] * 3


def test_empty_column(spark):
    df = spark.createDataFrame([], "x double")
    assert q.quantiles(df, ["x"], QUARTILES) == {"x": []}


def test_ties_share_a_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 1, 1, 1, 1, 2, 3, 4)], "x double")
    edges = q.cut_points(df, ["x"], 4).toDF("e")
    binned = df.crossJoin(F.broadcast(edges)).select(
        "x",
        q.bin_number(F.col("x"), F.col("e"), 4).alias("up"),
        q.bin_number(F.col("x"), F.col("e"), 4, descending=True).alias("down"),
    )
    # Edges 1, 1, 2.25; bins are closed on the right.
    assert {(r.x, r.up, r.down) for r in binned.collect()} == {(1.0, 1, 4), (2.0, 3, 2), (3.0, 4, 1), (4.0, 4, 1)}


def test_stretches_are_even_for_heavy_tails(spark, monkeypatch, staging):
    """Exponential values and a bracket over all of them, as after misses."""
    generator = np.random.default_rng(3)
    values = np.exp(generator.exponential(4, 40_000))
    df = staging.pin(spark.createDataFrame([(float(x),) for x in values], "x double").repartition(6), "values")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # so little would be one stretch
    try:
        dealt = q.deal_by_rank(df, ["x"], staging)
    finally:
        spark.conf.set(merging, "true")
    sizes = [r["count"] for r in dealt.groupBy("stretch").count().collect()]
    assert len(sizes) >= 2 and max(sizes) <= 3 * sum(sizes) / len(sizes)
    monkeypatch.setattr(q, "MARGIN", 1.0)
    assert q.quantiles(df, ["x"], QUARTILES, staging)["x"] == pytest.approx(list(np.quantile(values, QUARTILES)), rel=1e-12)
