"""Rounding and money sums that give the same answer for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fine enough for unit prices, with 18 digits left of the point; sums widen it to 38.
MONEY = "decimal(28,10)"
RESIDUE = "decimal(38,30)"
PARTS = ("money", "small", "dust", "unfit")


def round_half_even(value: Column) -> Column:
    """Two decimals, ties of the scaled double to the even neighbour."""
    return F.rint(value * 100) / 100


def round_exact(value: Column) -> Column:
    """Two decimals, rounding the double's exact binary value (ties to even).

    `value * 100` can itself round onto a tie. Only then the product's lost part
    matters: it is recovered by splitting the double in two halves whose products are
    exact, and its sign says which side of the tie the exact value lies on.
    """
    scaled = value * 100
    shifted = value * 134217729.0  # 2^27 + 1
    high = shifted - (shifted - value)
    lost = (high * 100 - scaled) + (value - high) * 100
    on_tie = (scaled - F.floor(scaled)) == 0.5
    whole = (
        F.when(on_tie & (lost > 0), F.ceil(scaled).cast("double"))
        .when(on_tie & (lost < 0), F.floor(scaled).cast("double"))
        .otherwise(F.rint(scaled))
    )
    return whole / 100


def percent(failed: Column, checked: Column) -> Column:
    """Failed rows per hundred checked, two decimals; 0 when nothing was checked."""
    ratio = (failed * 100).cast("double") / F.when(checked > 0, checked).cast("double")
    return F.coalesce(round_exact(ratio), F.lit(0.0))


def money_parts(amount: Column, name: str) -> list[Column]:
    """Aggregates that add up a double column without regard to the order of the rows.

    Amounts are added as decimals of ten places, and what these leave of each amount as
    decimals of thirty. What is smaller still is added as doubles. An amount that no
    decimal of 18 digits before the point can hold is only counted: see `money_total`.
    """
    money = amount.try_cast(MONEY)
    left = F.nullif(amount - money.cast("double"), F.lit(0.0))  # mostly nothing: then not cast
    small = left.try_cast(RESIDUE)
    return [
        F.sum(money).alias(f"{name}_money"),
        F.sum(small).alias(f"{name}_small"),
        F.sum(left - small.cast("double")).alias(f"{name}_dust"),
        F.count(F.when(amount.isNotNull() & money.isNull(), 1)).alias(f"{name}_unfit"),
    ]


def parts_where(name: str, condition: Column | None = None) -> dict[str, Column]:
    """The parts of a group by name, or nothing where the condition does not hold."""
    parts = {f"{name}_{part}": F.col(f"{name}_{part}") for part in PARTS}
    return parts if condition is None else {n: F.when(condition, part) for n, part in parts.items()}


def money_total(name: str) -> Column:
    """Aggregate the parts of many groups to one double; 0 if there is nothing to add.

    Raises if there are amounts that were too large to be added exactly.
    """

    def total(part: str) -> Column:
        return F.coalesce(F.sum(f"{name}_{part}").cast("double"), F.lit(0.0))

    unfit = total("unfit").cast("bigint")
    problem = F.concat(unfit.cast("string"), F.lit(f" amounts of {name} are too large to be added"))
    return F.when(unfit > 0, F.raise_error(problem).cast("double")).otherwise(
        total("money") + (total("small") + total("dust"))
    )
