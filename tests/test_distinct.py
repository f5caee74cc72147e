import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.distinct import by_key, condition_bits, count_keys
from sluice.operators.keys import flag_members, flag_orphans, staged_orphans

CONDITIONS = [lambda: F.lit(True), lambda: F.col("x") > 5, lambda: F.col("x") < 3]


def counted(rows, unique=False):
    conditions = [c() for c in CONDITIONS]
    found = by_key(rows, "g", "k", conditions, {"total": F.col("x")}, unique)
    return found.groupBy("g").agg(*(count_keys(i).alias(f"n{i}") for i in range(3)), F.sum("total").alias("total"))


def test_counts_equal_distinct_counts(spark):
    pick = random.Random(1)
    data = [(pick.choice("ab") if i % 3 else "hot", pick.choice([None, *range(30)]), pick.choice([None, *range(9)])) for i in range(900)]
    rows = spark.createDataFrame(data, "g string, k bigint, x bigint").repartition(4)
    plain = rows.groupBy("g").agg(
        *(F.count_distinct(F.when(c(), F.col("k"))).alias(f"n{i}") for i, c in enumerate(CONDITIONS)),
        F.sum("x").alias("total"),
    )
    assert sorted(map(tuple, counted(rows).collect())) == sorted(map(tuple, plain.collect()))
    assert counted(rows.limit(0)).collect() == []


def test_known_unique_rows_are_not_combined(spark):
    rows = spark.range(100).repartition(2).selectExpr("CAST(id % 3 AS string) AS g", "id AS k", "id % 10 AS x")
    assert sorted(map(tuple, counted(rows, unique=True).collect())) == sorted(map(tuple, counted(rows).collect()))
    plan = counted(rows, unique=True)._jdf.queryExecution().toString()
    assert plan.count("Exchange") < counted(rows)._jdf.queryExecution().toString().count("Exchange")


def test_rows_are_not_expanded(spark):
    rows = spark.range(10).selectExpr("id % 3 AS g", "id AS k", "id AS x")
    assert "Expand" not in counted(rows)._jdf.queryExecution().toString()


@pytest.mark.parametrize("n", [0, 63])
def test_number_of_conditions(spark, n):
    with pytest.raises(ValueError, match="conditions"):
        condition_bits([F.lit(True)] * n)


@pytest.mark.parametrize("unique", [False, True])
def test_members_equal_counted_orphans(spark, staging, unique):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"K{i % 11}") for i in range(200)], "i bigint, fk string")
    keys = [(f"K{i}",) for i in range(0, 11, 2)] + [(None,)] + ([] if unique else [("K2",), ("K2",)])
    parents = spark.createDataFrame(keys, "key string")
    small = flag_members(rows, "fk", parents, "orphan", unique)
    verdicts = staged_orphans(rows.select("fk"), "fk", parents, rows.count(), staging)
    large = flag_orphans(rows, "fk", verdicts, "orphan", ["i"])
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    assert small.columns == ["i", "fk", "orphan"]
