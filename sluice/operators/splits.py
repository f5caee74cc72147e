"""Operators that divide a DataFrame's rows into (kept, set apart).

All take any DataFrame. Both halves are lazy; referential integrity and deduplication
run a job on the key columns first, to find the exceptional keys.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sluice.config import ROW_ORDER
from sluice.functions import cleaning as c
from sluice.operators.keys import flag_duplicates, flag_members, flag_orphans, staged_orphans, staged_repeats
from sluice.operators.skew import fits_broadcast
from sluice.sources.staging import Staging

Split = tuple[DataFrame, DataFrame]


def split_outside_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> Split:
    """(rows within inclusive bounds or null, rows outside)."""
    outside = c.outside_range(F.col(column), low, high)
    return df.where(~outside), df.where(outside)


def nullify_not_in_set(df: DataFrame, column: str, allowed: Collection[str]) -> Split:
    """(all rows with unknown values nulled, an audit copy of the rows that had one)."""
    unknown = c.not_in_set(F.col(column), allowed)
    return df.withColumn(column, F.when(~unknown, F.col(column))), df.where(unknown)


def drop_null_keys(df: DataFrame, key: str) -> Split:
    """(rows with a key, rows without)."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())


def split_orphans(
    df: DataFrame,
    fk: str,
    valid_keys: DataFrame | Collection,
    staging: Staging | None = None,
) -> Split:
    """(rows whose foreign key has a parent or is null, rows whose key has none).

    `valid_keys` is a one-column DataFrame of parent keys, or a collection of them.
    """
    staging = staging or Staging(df.sparkSession)
    if not isinstance(valid_keys, DataFrame):
        kind = StructType([StructField(fk, df.schema[fk].dataType)])
        valid_keys = df.sparkSession.createDataFrame([(key,) for key in valid_keys], kind)
    if fits_broadcast(valid_keys):
        flagged = flag_members(df, fk, valid_keys, "_orphan")
    else:
        verdicts = staged_orphans(df.select(fk), fk, valid_keys, df.count(), staging)
        flagged = flag_orphans(df, fk, verdicts, "_orphan", spread_by=df.columns)
    return flagged.where("NOT _orphan").drop("_orphan"), flagged.where("_orphan").drop("_orphan")


def with_row_order(df: DataFrame, staging: Staging) -> DataFrame:
    """Number the rows. Written out, because the numbers must not change on a re-run."""
    return staging.pin(df.withColumn(ROW_ORDER, F.monotonically_increasing_id()), "numbered")


def deduplicate_by_key(
    df: DataFrame,
    key: str,
    order_by: str | None = None,
    descending: bool = True,
    row_order: str = ROW_ORDER,
    staging: Staging | None = None,
) -> Split:
    """(one row per key, the other rows).

    Kept is the row with the greatest `order_by` (nulls last, either direction), or the
    first one without it. `row_order` names a unique column that says which row is
    first and settles ties; without such a column the rows are numbered as they come.
    """
    staging = staging or Staging(df.sparkSession)
    numbered = df if row_order in df.columns else with_row_order(df, staging)
    order = row_order if row_order in df.columns else ROW_ORDER
    narrow = numbered.select(*dict.fromkeys(n for n in (key, order_by, order) if n))
    verdicts = staged_repeats(narrow, key, order, numbered.count(), staging, order_by, descending)
    flagged = flag_duplicates(numbered, key, verdicts, order, "_duplicate")
    return (
        flagged.where("NOT _duplicate").select(*df.columns),
        flagged.where("_duplicate").select(*df.columns),
    )


def quarantine(*frames_with_reason: tuple[DataFrame, str]) -> DataFrame:
    """Rejected frames under one another, each row with its `reject_reason`.

    Columns are matched by name and missing ones are null. Columns of the same name
    must have the same type, since a union would otherwise coerce them silently.
    """
    types: dict[str, object] = {}
    result = None
    for frame, reason in frames_with_reason:
        for field in frame.schema:
            if types.setdefault(field.name, field.dataType) != field.dataType:
                raise TypeError(f"column {field.name} has different types in the frames")
        tagged = frame.withColumn("reject_reason", F.lit(reason))
        result = tagged if result is None else result.unionByName(tagged, allowMissingColumns=True)
    if result is None:
        raise ValueError("nothing to quarantine")
    return result
