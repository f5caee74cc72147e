import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluice.operators import splits
from tests.helpers import texts, values


def test_drop_null_keys(spark):
    df = spark.createDataFrame([(k if k % 3 else None, k) for k in range(9)], "key int, n int")
    kept, rejected = splits.drop_null_keys(df, "key")
    assert values(kept, "n") == [1, 2, 4, 5, 7, 8]
    assert values(rejected, "n") == [0, 3, 6]


@pytest.mark.parametrize(
    ("low", "high", "outside"),
    [(None, None, []), (2.5, None, [-9.0, 2.0]), (None, 7.0, [float("inf"), float("nan")]), (2.0, 7.0, [-9.0, float("inf"), float("nan")])],
)
def test_split_outside_range(spark, low, high, outside):
    numbers = [-9.0, 2.0, 7.0, None, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in numbers], "a double")
    kept, rejected = splits.split_outside_range(df, "a", low, high)
    assert list(map(str, values(rejected, "a"))) == list(map(str, outside))
    assert kept.count() == len(numbers) - len(outside)


def test_nullify_not_in_set(spark):
    df = texts(spark, "a", ["north", "North", None, "", "south", "norths"])
    cleaned, audit = splits.nullify_not_in_set(df, "a", {"north", "south"})
    assert values(cleaned, "a") == ["north", None, None, None, "south", None]
    assert values(audit, "a") == ["North", "", "norths"]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("as_frame", [True, False])
def test_split_orphans_of_any_columns(spark, staging, as_frame, threshold):
    """Both ways to look up keys take the same frames, maps included."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        df = spark.createDataFrame([(k, f"k{k % 5}" if k % 7 else None) for k in range(40)], "n int, fk string")
        df = df.withColumn("m", F.create_map("n", "fk")).withColumn("deep", F.array(F.struct("m")))
        keys = ["k0", "k3", "k3", "other", None]
        kept, orphans = splits.split_orphans(df, "fk", texts(spark, "id", keys) if as_frame else keys, staging)
        known = [r.n for r in df.collect() if r.fk in (None, "k0", "k3")]
        assert sorted(values(kept, "n")) == known
        assert sorted(values(orphans, "n")) == sorted({r.n for r in df.collect()} - set(known))
        assert kept.columns == orphans.columns == df.columns
    finally:
        spark.conf.set(name, before)


def test_deduplicate_by_a_column(spark, staging):
    rows = [("a", 3, "x"), ("a", 9, "y"), ("a", None, "z"), ("b", None, "u"), (None, 1, "v"), (None, 2, "w")]
    df = spark.createDataFrame(rows, "id string, at int, v string")
    for descending, best in ((True, ["u", "w", "y"]), (False, ["u", "v", "x"])):
        kept, removed = splits.deduplicate_by_key(df, "id", "at", descending, staging=staging)
        assert sorted(values(kept, "v")) == best and kept.columns == df.columns
        assert sorted(values(removed, "v")) == sorted({r[2] for r in rows} - set(best))


def test_deduplicate_keeps_the_first_row(spark, staging):
    df = spark.range(100).select((F.col("id") % 9).alias("key"), F.col("id").alias("n")).coalesce(1)
    kept, removed = splits.deduplicate_by_key(df, "key", staging=staging)
    assert sorted(values(kept, "n")) == list(range(9))
    assert sorted(values(removed, "n")) == list(range(9, 100))


def test_quarantine_unites_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "id string, a string")
    b = spark.createDataFrame([("2", "y")], "id string, b string")
    rows = splits.quarantine((a, "first"), (b, "second")).collect()
    assert [tuple(r[c] for c in ("id", "a", "b", "reject_reason")) for r in rows] == [
        ("1", "x", None, "first"),
        ("2", None, "y", "second"),
    ]


def test_quarantine_refuses_mixed_types(spark):
    with pytest.raises(TypeError):
        splits.quarantine(
            (spark.createDataFrame([(1,)], "id bigint"), "a"), (spark.createDataFrame([("1",)], "id string"), "b")
        )


def skewed_rows(seed, n=6000):
    """A third of the rows on one key, a tenth without, exact copies, many ties."""
    generator = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        draw = generator.random()
        key = "HOT" if draw < 0.33 else None if draw < 0.43 else f"K{generator.randrange(2500)}"
        at = None if generator.random() < 0.2 else start + timedelta(days=generator.randrange(5))
        rows.append((i, key, at, generator.randrange(3), generator.choice(["a", "b", None])))
    return rows


SCHEMA = "_ord bigint, k string, at timestamp_ntz, n int, t string"


def best_rows(rows, column, descending):
    """Brute force: the row order kept of each key, null being a key as well."""
    winners = {}
    for row in rows:
        winners.setdefault(row[1], []).append(row)

    def first(group):
        if column is None:
            return min(group)[0]
        known = [r for r in group if r[column] is not None]
        if not known:
            return min(group)[0]
        target = (max if descending else min)(r[column] for r in known)
        return min(r for r in known if r[column] == target)[0]

    return sorted(first(group) for group in winners.values())


@pytest.mark.parametrize(
    "name, position, descending",
    [(None, None, True), ("at", 2, True), ("at", 2, False), ("n", 3, True), ("t", 4, True), ("t", 4, False)],
)
def test_deduplicate_skewed(spark, staging, shuffled_joins, name, position, descending):
    rows = skewed_rows(3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(8, "n")
    kept, removed = splits.deduplicate_by_key(df, "k", name, descending, staging=staging)
    expected = best_rows(rows, position, descending)
    assert sorted(values(kept, "_ord")) == expected
    assert sorted(values(removed, "_ord")) == sorted({r[0] for r in rows} - set(expected))


def test_orphans_skewed(spark, staging, shuffled_joins):
    rows = skewed_rows(5)
    parents = [f"K{i}" for i in range(0, 2500, 3)]
    for keys in (parents, [*parents, "HOT"]):
        df = spark.createDataFrame(rows, SCHEMA).select("k", "t")  # full of exact copies
        kept, orphans = splits.split_orphans(df, "k", texts(spark, "id", keys), staging)
        known = set(keys)
        expected = Counter((r[1], r[4]) for r in rows if r[1] is not None and r[1] not in known)
        assert Counter(map(tuple, orphans.collect())) == expected
        assert Counter(map(tuple, kept.collect())) == Counter((r[1], r[4]) for r in rows) - expected


def test_hot_rows_are_spread(spark, staging, shuffled_joins):
    """Rows of a hot key must not end up in one partition when rows are shuffled."""
    rows = [(i, "HOT" if i % 3 == 0 else f"K{i}", None, 0, "a") for i in range(30000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept, _ = splits.split_orphans(df, "k", texts(spark, "id", [f"K{i}" for i in range(0, 30000, 2)]), staging)
        _, orphans = splits.split_orphans(df, "k", texts(spark, "id", ["none"]), staging)
        sizes = orphans.where("k = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 10000
    assert len(sizes) == 4
    assert max(r["count"] for r in sizes) < 4000
    assert kept.where("k = 'HOT'").count() == 0


@pytest.mark.parametrize("kind", ["string", "binary", "boolean"])
def test_latest_by_text_in_one_pass(spark, staging, kind, monkeypatch):
    """The greatest text, its beginnings after it, nulls last, the first row of equal ones."""
    from sluice.operators import keys

    passes, matching = [], keys._matching
    monkeypatch.setattr(keys, "_matching", lambda *a: passes.append(1) or matching(*a))
    words = [None, "", "a", "ab", "abc", "é", "z", "\x00", "a\x00", "漢", "ab"]
    if kind == "boolean":
        words = [None, "true", "false", "true"]
    data = [(f"K{k}", w, 100 * k + i) for k in range(4) for i, w in enumerate(words[: len(words) - k])]
    df = spark.createDataFrame(data, "key string, word string, _ord bigint").withColumn("word", F.col("word").cast(kind))
    kept, _ = splits.deduplicate_by_key(df, "key", order_by="word", staging=staging)
    wanted = {}
    for row in df.collect():
        value = bytes(row.word) if kind == "binary" and row.word is not None else row.word
        value = value.encode() if isinstance(value, str) else value
        best = wanted.get(row.key)
        if best is None or value is not None and (best[0] is None or value > best[0]):
            wanted[row.key] = (value, row._ord)
    assert {r.key: r._ord for r in kept.collect()} == {k: o for k, (_, o) in wanted.items()}
    assert len(passes) == 1
