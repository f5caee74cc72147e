"""Verdicts on keys: which foreign keys are orphans, which primary keys repeat.

Both are decided on the key columns alone. The result is a small table of exceptional
keys that is then looked up from the full rows, so the full rows are not shuffled by
key as long as exceptions are few. `total` is the number of full rows, against which a
key counts as hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.skew import fits_broadcast, lookup, mark_hot
from sluice.sources.staging import Staging


def orphan_keys(rows: DataFrame, fk: str, parent_keys: DataFrame, total: int) -> DataFrame:
    """Foreign keys without a parent, plus all hot keys: (fk, n_rows, orphan, hot).

    Counting per key leaves one row per key on both sides of the join, so that no key
    weighs more than another.
    """
    parent = parent_keys.toDF("_parent").where(F.col("_parent").isNotNull()).distinct()
    counts = rows.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    checked = counts.join(parent, counts[fk] == parent["_parent"], "left").select(
        fk, "n_rows", F.col("_parent").isNull().alias("orphan")
    )
    return mark_hot(checked, total).where(F.col("orphan") | F.col("hot"))


def flag_orphans(
    rows: DataFrame, fk: str, verdicts: DataFrame, flag: str, spread_by: list[str]
) -> DataFrame:
    """Add the boolean `flag`: the row has a foreign key and it has no parent."""
    names = rows.columns
    found = lookup(
        rows,
        fk,
        verdicts,
        values=["orphan"],
        spread_by=spread_by,
    )
    return found.select(*names, F.coalesce("orphan", F.lit(False)).alias(flag))


def flag_members(
    rows: DataFrame, fk: str, parent_keys: DataFrame, flag: str, unique: bool = False
) -> DataFrame:
    """The same as `flag_orphans` for parent keys of a checked size: no row is shuffled.

    `unique` says that no parent key is there twice.

    The keys themselves are broadcast, once each. A bitmap of them would be smaller, but
    two keys can share a bit: it can prove that a parent is missing, never that it is there.
    """
    names = rows.columns
    parent = parent_keys.toDF("_parent").where(F.col("_parent").isNotNull())
    parent = parent if unique else parent.distinct()
    found = rows.join(F.broadcast(parent), F.col(fk) == F.col("_parent"), "left")
    return found.select(*names, (F.col(fk).isNotNull() & F.col("_parent").isNull()).alias(flag))


def _reversed(value: Column, dtype: T.DataType) -> Column | None:
    """A value that sorts the other way round, where the type has one."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") - value
    if isinstance(dtype, T.TimestampType):
        return -F.unix_micros(value)
    if isinstance(dtype, T.DateType):
        return -F.unix_date(value)
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return -value
    if isinstance(dtype, T.IntegralType):
        return -value.cast("decimal(20,0)")
    if isinstance(dtype, T.BooleanType):
        return ~value
    if isinstance(dtype, T.BinaryType) or dtype == T.StringType():
        # Text is in the order of its bytes: so are their hex digits, turned round they are
        # not. The end sorts after all digits, since what a text begins with comes before it.
        digits = F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210")
        return F.concat(digits, F.lit("G"))
    return None


def repeat_counts(rows: DataFrame, key: str, total: int) -> DataFrame:
    """Keys on more than one row: (key, n_rows, hot)."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    return mark_hot(counts, total)


def first_rows(rows: DataFrame, key: str, row_order: str, total: int) -> DataFrame:
    """Keys on more than one row and the row order of their first: (key, n_rows, winner, hot).

    The smallest row order is found by the aggregate that counts, so that rows of repeated
    keys, which can be many, are not shuffled again to find it. That is for a row order that
    is a number; a wide one would weigh more than the counts of all keys.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.min(row_order).alias("winner"))
    return mark_hot(counts.where("n_rows > 1"), total)


def _matching(rows: DataFrame, key: str, table: DataFrame, value: str, row_order: str) -> DataFrame:
    """Rows whose key (null included) is in `table`, with its `value`."""
    found = lookup(rows, key, table, values=[value], spread_by=[row_order], null_safe=True)
    return found.where("_found").drop("_found")


def repeat_winners(
    rows: DataFrame,
    key: str,
    repeats: DataFrame,
    row_order: str,
    order_by: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """The row order of the row to keep of each repeated key: (key, hot, winner).

    Aggregates rather than a ranking window: a key with very many rows shrinks to one
    row per task before it is shuffled.
    """
    found = _matching(rows, key, repeats, "hot", row_order)
    hot = F.max("hot").alias("hot")
    if order_by is None:
        return found.groupBy(key).agg(hot, F.min(row_order).alias("winner"))

    value = F.col(order_by)
    rank = _reversed(value, rows.schema[order_by].dataType) if descending else value
    if rank is None:
        # Types without a reverse, such as arrays: keep only rows with the greatest value.
        greatest = found.groupBy(key).agg(hot, F.max(order_by).alias("_best"))
        ties = _matching(found, key, greatest, "_best", row_order)
        found = ties.where(value.eqNullSafe(F.col("_best"))).drop("_best")
        rank = F.lit(0)
    best = F.min(
        F.struct(value.isNull().alias("missing"), rank.alias("rank"), F.col(row_order).alias("at"))
    )
    return found.groupBy(key).agg(hot, best["at"].alias("winner"))


def flag_duplicates(
    rows: DataFrame,
    key: str,
    verdicts: DataFrame,
    row_order: str,
    flag: str,
    active: Column | None = None,
) -> DataFrame:
    """Add the boolean `flag`: another row of the same key is kept instead of this one.

    Rows that are not `active` are never flagged. Where rows have to be shuffled, these stay
    where they are.
    """
    if active is not None and not fits_broadcast(verdicts):
        active = F.coalesce(active, F.lit(False))
        flagged = flag_duplicates(rows.where(active), key, verdicts, row_order, flag)
        return flagged.unionAll(rows.where(~active).withColumn(flag, F.lit(False)))
    names = rows.columns
    found = lookup(
        rows,
        key,
        verdicts,
        values=["winner"],
        spread_by=[row_order],
        active=active,
        null_safe=True,
    )
    loses = F.coalesce(F.col("winner") != F.col(row_order), F.lit(False))
    if active is not None:
        loses = active & loses
    return found.select(*names, loses.alias(flag))


def staged_orphans(
    rows: DataFrame, fk: str, parent_keys: DataFrame, total: int, staging: Staging
) -> DataFrame:
    verdicts = orphan_keys(rows, fk, parent_keys, total).select(fk, "orphan", "hot")
    return staging.pin(verdicts, f"orphans-{fk}")


def staged_repeats(
    rows: DataFrame,
    key: str,
    row_order: str,
    total: int,
    staging: Staging,
    order_by: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """Find repeated keys, then which of their rows to keep.

    In two steps because most keys are on one row: the first shuffles nothing but keys
    and counts, and only rows of repeated keys bring their order and position along.
    """
    repeats = staging.pin(repeat_counts(rows, key, total), f"repeats-{key}")
    winners = repeat_winners(rows, key, repeats, row_order, order_by, descending)
    return staging.pin(winners, f"winners-{key}")
