import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.contracts import Contract, ContractError, Field, contract_violations, validate

CONTRACT = Contract(
    (
        Field("id", T.StringType(), nullable=False, unique=True),
        Field("n", T.LongType(), gt=0),
        Field("p", T.DoubleType(), ge=0, le=5),
        Field("c", T.StringType(), isin=("a", "b")),
    )
)
SCHEMA = "id string, n bigint, p double, c string"


def found(df):
    return {(r["column"], r["check"]): r["failed"] for r in contract_violations(df, CONTRACT).collect()}


def test_valid_table(spark):
    df = spark.createDataFrame([("1", 1, 0.0, "a"), ("2", None, None, None), ("3", 5, 5.0, "b")], SCHEMA)
    assert found(df) == {}
    validate(df, CONTRACT)


def test_all_violations_are_reported_at_once(spark):
    rows = [("1", 0, -1.0, "z"), ("1", 1, 6.0, "a"), (None, -1, 1.0, None), ("2", 1, 1.0, "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == {
        ("id", "not_null"): 1,
        ("id", "unique"): 2,
        ("n", "gt(0)"): 2,
        ("p", "ge(0)"): 1,
        ("p", "le(5)"): 1,
        ("c", "isin"): 1,
    }
    with pytest.raises(ContractError) as error:
        validate(df, CONTRACT, "things")
    assert len(error.value.violations) == 6
    assert "things" in str(error.value)


def test_shape(spark):
    df = spark.createDataFrame([("1", 1, "a", "x")], "id string, n int, c string, extra string")
    assert set(found(df)) == {
        ("p", "column_in_dataframe"),
        ("extra", "column_in_schema"),
        ("n", "dtype(bigint)"),
    }


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    assert found(spark.range(1).select(F.lit("1").alias("id"), F.lit(None).cast("bigint").alias("n"),
                                       F.lit(None).cast("double").alias("p"), F.lit("a").alias("c"))) == {}
