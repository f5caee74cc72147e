"""Joining rows to a table with one row per key, whatever the key distribution.

A key that holds a large share of the rows ("hot") would send them all to one task if
the rows were shuffled by key. So hot keys are resolved without a shuffle, and the rows
that no longer need their key are spread evenly over the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least one row in HOT_SHARE. So there are at most
# HOT_SHARE hot keys, however large the data: that bounds what is broadcast.
HOT_SHARE = 1000


def mark_hot(key_counts: DataFrame, total: int) -> DataFrame:
    """Add `hot` to a table of (key, n_rows, ...) counted over (part of) `total` rows."""
    return key_counts.withColumn("hot", F.col("n_rows") * HOT_SHARE >= total)


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The hot values of `key`; counting combines on the map side first."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return mark_hot(counts, rows.count()).where("hot").select(key)


def fits_broadcast(table: DataFrame) -> bool:
    """Whether a stored table is so small, by the size of its files, that it is broadcast."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size <= limit


def hashable(rows: DataFrame) -> list[str]:
    """The columns that can be hashed: all but maps, and what has maps or variants within."""
    return [
        field.name
        for field in rows.schema
        if not any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))
    ]


def lookup(
    rows: DataFrame,
    key: str,
    table: DataFrame,
    values: list[str],
    spread_by: list[str],
    active: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left-join `rows` to a stored table (key, hot, *values), adding `values` and `_found`.

    The table has one row per key. A small one is joined as it is, which shuffles
    nothing; otherwise see `split_lookup`. Only the plan differs: both take the same rows
    and give the same answer. What is added to rows that are not `active` is undefined.
    """
    if not fits_broadcast(table):
        hot, cold = table.where("hot"), table.where("NOT hot")
        return split_lookup(rows, key, hot, cold, values, spread_by, active, null_safe)
    side = table.select(
        F.col(key).alias("_key"), *(F.col(v).alias(f"_at_{v}") for v in values), F.lit(True).alias("_hit")
    )
    same = F.col(key).eqNullSafe(F.col("_key")) if null_safe else F.col(key) == F.col("_key")
    return rows.join(side, same, "left").select(
        *rows.columns,
        *(F.col(f"_at_{v}").alias(v) for v in values),
        F.coalesce("_hit", F.lit(False)).alias("_found"),
    )


def split_lookup(
    rows: DataFrame,
    key: str,
    hot: DataFrame,
    cold: DataFrame,
    values: list[str],
    spread_by: list[str],
    active: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """The lookup for a table of any size, given in two parts.

    `hot` has its rows for hot keys (at most HOT_SHARE) and is broadcast. For `cold`,
    the others, both sides are shuffled by key. `spread_by` names columns that tell rows
    apart, as far as they can be hashed: rows that are already resolved, inactive or without a key get a spread number
    from them, so that the shuffle scatters those rows. The number is a hash of the row
    and of its input partition. So it scatters exact copies too, and it is the same when
    a lost task runs again.
    """
    names = rows.columns
    hot_side = F.broadcast(
        hot.select(
            F.col(key).alias("_hot_key"),
            *(F.col(v).alias(f"_hot_{v}") for v in values),
            F.lit(True).alias("_hot_found"),
        )
    )
    # Always 0, written so that it stays a join key instead of folding to a constant.
    no_spread = F.pmod(F.xxhash64(F.col(key)), F.lit(1).cast("bigint"))
    cold_side = cold.select(
        F.col(key).alias("_cold_key"),
        no_spread.alias("_cold_spread"),
        *(F.col(v).alias(f"_cold_{v}") for v in values),
        F.lit(True).alias("_cold_found"),
    )

    def matches(other: str) -> Column:
        return F.col(key).eqNullSafe(F.col(other)) if null_safe else F.col(key) == F.col(other)

    resolved = F.coalesce(F.col("_hot_found"), F.lit(False))
    if active is not None:
        resolved = resolved | ~active
    if not null_safe:
        resolved = resolved | F.col(key).isNull()
    usable = set(hashable(rows))
    spread = F.xxhash64(F.spark_partition_id(), *(name for name in spread_by if name in usable)).bitwiseOR(F.lit(1).cast("bigint"))  # never 0

    joined = (
        rows.join(hot_side, matches("_hot_key"), "left")
        .withColumn("_spread", F.when(resolved, spread).otherwise(F.lit(0).cast("bigint")))
        .join(cold_side, matches("_cold_key") & (F.col("_spread") == F.col("_cold_spread")), "left")
    )
    return joined.select(
        *names,
        *(F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values),
        F.coalesce("_hot_found", "_cold_found", F.lit(False)).alias("_found"),
    )
