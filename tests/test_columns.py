from datetime import datetime

import pytest
from pyspark.sql import types as T

from sluice.operators import columns
from tests.helpers import texts, values


ZONES = ["UTC", "America/Sao_Paulo", "Asia/Kolkata"]


@pytest.fixture(params=ZONES)
def zone(spark, request):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, before)


def test_strip_strings(spark):
    df = spark.createDataFrame([("\tone two ", "  keep "), ("\n \r", None), (None, "")], "a string, b string")
    out = columns.strip_strings(df, ["a"])
    assert values(out, "a") == ["one two", None, None]
    assert values(out, "b") == ["  keep ", None, ""]


def test_strip_takes_all_unicode_whitespace(spark):
    df = texts(spark, "a", ["\u2003left", "right\u3000\u00a0", "\u0085\u2028", "\u200bzero width stays"])
    assert values(columns.strip_strings(df, ["a"]), "a") == ["left", "right", None, "\u200bzero width stays"]


def test_case(spark):
    df = texts(spark, "a", ["ÀÉ straße X1", None, ""])
    assert values(columns.lowercase(df, "a"), "a") == ["àé straße x1", None, ""]
    assert values(columns.uppercase(df, "a"), "a") == ["ÀÉ STRASSE X1", None, ""]


def test_parse_datetime(spark, zone):
    """The hour from 0 to 1 of that day does not exist in one of the zones."""
    df = columns.parse_datetime(texts(spark, "a", ["2018-11-04 00:30:00", "1969-12-31 23:59:59", "soon", None]), "a")
    assert df.schema["a"].dataType == T.TimestampNTZType()
    assert values(df, "a") == [datetime(2018, 11, 4, 0, 30), datetime(1969, 12, 31, 23, 59, 59), None, None]


@pytest.mark.parametrize("text", ["2023-02-29 10:00:00", "2023-1-2 3:4:5", "2023-01-02", "2023-01-02 03:04:05Z", "2023-01-02 24:00:01"])
def test_parse_datetime_rejects(spark, text):
    assert values(columns.parse_datetime(texts(spark, "a", [text]), "a"), "a") == [None]


@pytest.mark.parametrize(
    ("pattern", "text", "expected"),
    [
        ("dd/MM/yyyy", "04/11/2018", datetime(2018, 11, 4)),
        ("dd/MM/yyyy HH:mm", "04/11/2018 00:30", datetime(2018, 11, 4, 0, 30)),
        ("yyyyMMdd HHmmss.SSSSSS", "19591231 235958.000007", datetime(1959, 12, 31, 23, 59, 58, 7)),
        ("dd/MM/yyyy", "31/02/2018", None),
        ("dd/MM/yyyy", None, None),
    ],
)
def test_parse_datetime_with_pattern(spark, zone, pattern, text, expected):
    df = columns.parse_datetime(texts(spark, "a", [text]), "a", pattern)
    assert df.schema["a"].dataType == T.TimestampNTZType() and values(df, "a") == [expected]


@pytest.mark.parametrize(
    ("cast", "good", "bad"),
    [
        (columns.cast_float, {"0.25": 0.25, "-7": -7.0, "2e-3": 0.002, "8.": 8.0, ".75": 0.75}, [" 1", "3.5d", "4f", "6\n", "inf", "NaN", ""]),
        (columns.cast_int, {"0": 0, "-12": -12, "+9": 9, "9223372036854775807": 2**63 - 1}, [" 1", "1.0", "2e2", "9223372036854775808", "0x1", ""]),
    ],
)
def test_casts_take_plain_numbers_only(spark, cast, good, bad):
    df, failed = cast(texts(spark, "a", [*good, *bad, None]), "a")
    assert values(df, "a") == [*good.values(), *[None] * (len(bad) + 1)]
    assert failed == len(bad)


@pytest.mark.parametrize(("low", "high", "kept"), [(2, None, [None, 2, 3, 9]), (None, 2, [1, 2, None, None]), (2, 3, [None, 2, 3, None]), (None, None, [1, 2, 3, 9])])
def test_nullify_outside_range(spark, low, high, kept):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 9, None)], "a bigint")
    cleaned, nulled = columns.nullify_outside_range(df, "a", low, high)
    assert values(cleaned, "a") == [*kept, None]
    assert nulled == kept.count(None)
