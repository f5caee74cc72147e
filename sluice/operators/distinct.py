"""Distinct counts under several conditions, from one small number per group and key.

Counting the distinct keys of a group once for each condition would copy every row per
condition before the shuffle. Here a key's conditions are bits of one number: rows of
a (group, key) are combined by `bit_or` where they are read, together with whatever else
is summed, and a second aggregate counts the keys that have each bit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = "_bits"


def condition_bits(conditions: Sequence[Column]) -> Column:
    """One integer with bit i set where the i-th condition holds (null does not hold)."""
    if not 0 < len(conditions) <= 62:
        raise ValueError(f"between 1 and 62 conditions, not {len(conditions)}")
    bits = F.lit(0).cast("bigint")
    for i, condition in enumerate(conditions):
        bits = bits + F.when(condition, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return bits


def by_key(
    rows: DataFrame,
    group: str,
    key: str,
    conditions: Sequence[Column],
    sums: Mapping[str, Column],
    unique: bool = False,
) -> DataFrame:
    """One row per (group, key): the bits of the conditions any of its rows meets, and the sums.

    Rows without a key keep their sums, but meet no condition. Where rows are known to be
    `unique` by group and key there is nothing to combine: this is a projection then.
    """
    bits = condition_bits([F.col(key).isNotNull() & condition for condition in conditions])
    if unique:
        return rows.select(group, key, bits.alias(BITS), *(c.alias(name) for name, c in sums.items()))
    combined = (F.sum(c).alias(name) for name, c in sums.items())
    return rows.groupBy(group, key).agg(F.bit_or(bits).alias(BITS), *combined)


def count_keys(i: int) -> Column:
    """Aggregate the rows of `by_key`: how many keys met condition i."""
    return F.count(F.when(F.getbit(F.col(BITS), F.lit(i)) == 1, F.lit(1)))
