import random

import pytest
from pyspark.sql import functions as F

from sluice.functions.numbers import money_parts, money_total, percent, round_exact, round_half_even


def test_round_exact_is_pythons_round(spark):
    generator = random.Random(7)
    numbers = [0.125, 2.675, 1.115, 0.375, 0.0, 100.0, 33.335, 0.005, 0.015, 99.995]
    numbers += [generator.randrange(0, 20001) / 200 for _ in range(3000)]
    numbers += [100 * generator.randrange(0, 60000) / 60000 for _ in range(3000)]
    df = spark.createDataFrame([(n,) for n in numbers], "n double")
    rounded = df.select("n", round_exact(F.col("n")).alias("r")).collect()
    assert [row.r for row in rounded] == [round(row.n, 2) for row in rounded]


def test_round_half_even_scales_first(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (0.375,), (-0.125,)], "n double")
    rounded = [row[0] for row in df.select(round_half_even(F.col("n"))).collect()]
    assert rounded == [2.68, 0.12, 0.38, -0.12]


def test_percent(spark):
    df = spark.createDataFrame([(2, 4), (45, 5000), (0, 0), (669, 60000)], "failed bigint, checked bigint")
    rows = df.select(percent(F.col("failed"), F.col("checked"))).collect()
    assert [row[0] for row in rows] == [50.0, 0.9, 0.0, 1.11]


def total_of(df):
    return df.agg(*money_parts(F.col("a"), "x")).agg(money_total("x")).first()[0]


def amounts_of(spark, amounts):
    return spark.createDataFrame([(a,) for a in amounts], "a double")


def test_money_does_not_depend_on_order(spark):
    assert total_of(amounts_of(spark, [0.1] * 10 + [None])) == 1.0
    generator = random.Random(4)
    amounts = [generator.uniform(-1, 1) * 10 ** generator.randrange(-25, 17) for _ in range(2000)]
    totals = set()
    for _ in range(4):
        generator.shuffle(amounts)
        totals.add(total_of(amounts_of(spark, amounts).repartition(generator.randrange(1, 9))))
    assert len(totals) == 1
    assert total_of(amounts_of(spark, [None])) == 0.0


def test_small_amounts_add_up(spark):
    assert total_of(amounts_of(spark, [1e-11] * 100)) == pytest.approx(1e-9, rel=1e-12)
    assert total_of(amounts_of(spark, [1e-40] * 100)) == pytest.approx(1e-38, rel=1e-12)
    assert total_of(amounts_of(spark, [1e-11, 1e-11, 5.25])) == pytest.approx(5.25 + 2e-11, rel=1e-15)


@pytest.mark.parametrize("amount", [1e18, -1e30, float("inf")])
def test_amounts_beyond_the_decimals_raise(spark, amount):
    with pytest.raises(Exception, match="2 amounts of x are too large"):
        total_of(amounts_of(spark, [1.0, amount, amount]))


def test_nothing_left_is_not_added(spark):
    """Amounts that ten places hold leave no residue to cast; others keep theirs."""
    parts = lambda *v: spark.createDataFrame([(x,) for x in v], "x double").agg(*money_parts(F.col("x"), "m")).first()
    assert parts(1.5, 0.1, 12345678.91, None).m_small is None
    assert float(parts(1.5, 1e-13).m_small) == 1e-13
