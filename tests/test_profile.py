from sluice.operators import profile
from tests.helpers import texts, values


def test_distinct_values(spark):
    df = texts(spark, "a", ["b", None, "a", "b"])
    assert values(profile.distinct_values(df, "a"), "a") == ["a", "b"]


def test_value_counts(spark):
    df = texts(spark, "a", [" B", "b", None, "  ", "a"])
    counted = profile.value_counts(df, "a", normalize_text=True)
    assert [tuple(r) for r in counted.collect()] == [("b", 2), (None, 1), ("", 1), ("a", 1)]


def test_sample_and_head(spark):
    df = spark.range(10_000)
    size = profile.sample(df).count()
    assert 800 < size < 1200
    assert profile.sample(df).count() == size
    assert profile.head(df).count() == 5
