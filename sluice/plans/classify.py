"""One pass over a Bronze table that decides the fate of every row.

Each row gets its cleaned columns, a flag for every quality check, and the reason for
its removal, if any. Silver, quarantine and quality are projections of that one frame.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sluice.config import ROW_ORDER
from sluice.functions import cleaning as c
from sluice.operators.contracts import usable_columns
from sluice.operators.keys import (
    first_rows,
    flag_duplicates,
    flag_members,
    flag_orphans,
    repeat_counts,
    repeat_winners,
    staged_orphans,
)
from sluice.operators.quality import Check, check_counts, count_all, count_true, measure
from sluice.operators.skew import fits_broadcast
from sluice.plans.specs import (
    DATETIME,
    FLOAT,
    INTEGER,
    SPECS,
    Column,
    Missing,
    Orphan,
    OutOfRange,
    Rule,
    TableSpec,
)
from sluice.sources.staging import Staging, together

REASON = "_reason"
REJECT_REASON = "reject_reason"
# Tables whose keys others are checked against. What of these is broadcast is decided by the
# size of their files, so they keep the session's codec.
PARENTS = {parent for spec in SPECS.values() for parent in spec.parents}
# The others are stored smaller, for the same time.
ROWS_CODEC = "zstd"


def _lost(column: str) -> str:
    return f"_lost_{column}"


def _outside(column: str) -> str:
    return f"_outside_{column}"


def _audit(column: str) -> str:
    return f"_audit_{column}"


def _absent(column: str) -> str:
    return f"_absent_{column}"


def _orphan(column: str) -> str:
    return f"_orphan_{column}"


def _codec(spec: TableSpec) -> str | None:
    return None if spec.name in PARENTS else ROWS_CODEC


def _typed(column: Column) -> SparkColumn:
    """The value after trimming, case folding, parsing or casting."""
    raw = F.col(column.name)
    if column.kind == INTEGER:
        return c.to_bigint(raw)
    if column.kind == FLOAT:
        return c.to_double(raw)
    if column.kind == DATETIME:
        return c.to_datetime(raw)
    text = c.strip(raw)
    return {"lower": F.lower, "upper": F.upper, None: lambda t: t}[column.case](text)


def _checked(column: Column) -> list[SparkColumn]:
    """From a typed column: its final value, then the flags and audit value it gives rise to."""
    name, value = column.name, F.col(column.name)
    flags = []
    if column.kind in (INTEGER, FLOAT):
        flags.append((~F.col(_absent(name)) & value.isNull()).alias(_lost(name)))
    if column.bounded:
        outside = c.outside_range(value, column.low, column.high)
        flags.append(outside.alias(_outside(name)))
        value = F.when(~outside, value)
    if column.accepted:
        unknown = c.not_in_set(value, column.accepted)
        flags.append(F.when(unknown, value).alias(_audit(name)))
        value = F.when(~unknown, value)
    return [value.alias(name), *flags]


def normalize(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """Cleaned columns, the flags to count, and the values kept for audit.

    Two projections: every value is parsed once in the first and used in the second.
    """
    rules = {column.name: column for column in spec.columns}
    counted = [n for n in spec.column_names if n in spec.descriptive or rules[n].kind in (INTEGER, FLOAT)]
    typed = bronze.select(
        *(
            _typed(rules[name]).alias(name) if name in rules else F.col(name)
            for name in bronze.columns
        ),
        *(F.col(name).isNull().alias(_absent(name)) for name in counted),
    )
    output = []
    for name in bronze.columns:
        output += _checked(rules[name]) if name in rules else [F.col(name)]
    return typed.select(*output, *(_absent(name) for name in counted))


def _broken(rule: Rule) -> SparkColumn:
    if isinstance(rule, OutOfRange):
        return c.outside_range(F.col(rule.column), rule.low, rule.high)
    if isinstance(rule, Missing):
        return F.col(rule.column).isNull()
    return F.col(_orphan(rule.column))


@dataclass(frozen=True)
class Judged:
    """Normalized rows with the first rule each one breaks, before deduplication."""

    spec: TableSpec
    rows: DataFrame
    columns: list[str]
    total: int
    survivors: int

    def keys(self) -> DataFrame:
        """The keys Silver will have: deduplication keeps one row of every key."""
        return self.rows.where(F.col(REASON).isNull()).select(self.spec.key).distinct()


def apply_rules(
    bronze: DataFrame,
    spec: TableSpec,
    parent_keys: dict[str, DataFrame],
    staging: Staging,
    unique_parents: bool = False,
) -> Judged:
    """Clean every row of a Bronze table and find the first rule it breaks.

    `bronze` must carry the unique `_ord` column that Bronze ingestion adds.
    `parent_keys` has a one-column frame of valid keys for each parent table;
    `unique_parents` says that these frames have no key twice, as Silver has not.
    """
    rows = normalize(bronze, spec)
    # Parents that are small enough are joined as they are. Keys of the others are checked
    # apart from the rows; only that needs to know the number of rows beforehand.
    large = [rule for rule in spec.orphan_rules if not fits_broadcast(parent_keys[rule.parent])]
    total = bronze.count() if large else 0

    def verdicts(rule: Orphan) -> DataFrame:
        keys = parent_keys[rule.parent]
        return staged_orphans(rows.select(rule.column), rule.column, keys, total, staging)

    found = dict(zip(large, together(verdicts, large)))
    judged = rows
    for rule in spec.orphan_rules:
        flag = _orphan(rule.column)
        if rule in found:
            judged = flag_orphans(judged, rule.column, found[rule], flag, [ROW_ORDER])
        else:
            judged = flag_members(judged, rule.column, parent_keys[rule.parent], flag, unique_parents)
    reason = F.coalesce(*(F.when(_broken(rule), F.lit(rule.reason)) for rule in spec.rules))
    columns = [name for name in bronze.columns if name != ROW_ORDER]
    # Stored, so that rows are parsed and looked up once for all that follows; counted
    # in the stage that writes, where a task that runs again is not counted twice.
    seen = Observation()
    counted = judged.withColumn(REASON, reason).observe(
        seen, count_all().alias("rows"), count_true(F.col(REASON).isNull()).alias("survivors")
    )
    stored = staging.pin(counted, f"judged-{spec.name}", _codec(spec))
    return Judged(spec, stored, columns, seen.get["rows"], seen.get["survivors"])


@dataclass(frozen=True)
class Classified:
    """A table's rows with their fate; everything else is read off it lazily.

    `counts` has what was counted while the rows were stored: `checked` and `failed_i` of
    the checks, `rule_i` of the contract's rules on rows that survive, `silver` these rows.
    `unique_rows` is how many of them there are if each key is on one row.
    """

    spec: TableSpec
    rows: DataFrame
    columns: list[str]
    counts: dict[str, int] = field(default_factory=dict)
    unique_rows: int = 0

    @property
    def survives(self) -> SparkColumn:
        return F.col(REASON).isNull()

    def silver(self) -> DataFrame:
        return self.rows.where(self.survives).select(*self.columns)

    def _entries(self, rows: DataFrame, reasons: SparkColumn) -> DataFrame:
        """A row per reason: as it is, or with the value that Silver has not, for audit copies."""
        audited = [column for column in self.spec.columns if column.accepted]
        expanded = rows.withColumn(REJECT_REASON, F.explode(reasons))
        original = {
            column.name: F.when(
                F.col(REJECT_REASON) == column.reject_reason, F.col(_audit(column.name))
            ).otherwise(F.col(column.name))
            for column in audited
        }
        values = [original.get(name, F.col(name)).alias(name) for name in self.columns]
        return expanded.select(*values, REJECT_REASON)

    def _audits(self) -> tuple[SparkColumn, SparkColumn]:
        """(whether a row has audit copies, their reasons)."""
        audits = [
            F.when(F.col(_audit(column.name)).isNotNull(), F.lit(column.reject_reason))
            for column in self.spec.columns
            if column.accepted
        ]
        if not audits:
            return F.lit(False), F.array().cast("array<string>")
        return reduce(or_, (audit.isNotNull() for audit in audits)), F.array_compact(F.array(*audits))

    def quarantine(self) -> DataFrame:
        """Removed rows with their reason, and audit copies with the value nulled in Silver.

        A row can appear both ways, so it is expanded into its entries in place instead
        of reading the table once per reason.
        """
        has_audits, audits = self._audits()
        removed = self.rows.where(~self.survives | has_audits)
        return self._entries(removed, F.array_compact(F.concat(F.array(F.col(REASON)), audits)))

    def fates(self) -> DataFrame:
        """Silver and quarantine under one another: Silver's rows have no `reject_reason`."""
        has_audits, audits = self._audits()
        own = F.array(F.col(REASON))
        return self._entries(self.rows, F.when(has_audits, F.concat(own, audits)).otherwise(own))

    def to_count(self) -> list[SparkColumn]:
        """The aggregates that `counts` holds."""
        rules = self.spec.contract.row_rules(usable_columns(self.silver(), self.spec.contract))
        broken = [count_true(self.survives & b).alias(f"rule_{i}") for i, (_, _, b) in enumerate(rules)]
        return [*check_counts(self.checks()), *broken, count_true(self.survives).alias("silver")]

    def checks(self) -> list[Check]:
        """The quality checks of this table, as conditions on the classified rows."""
        spec, reason = self.spec, F.col(REASON)

        def removed(why: str) -> SparkColumn:
            return reason.eqNullSafe(F.lit(why))

        def check(name: str, column: str, stage: str, failed: SparkColumn) -> Check:
            return Check(name, spec.name, column, stage, failed)

        checks = [check("null_check", n, "bronze", F.col(_absent(n))) for n in spec.descriptive]
        checks.append(check("null_check", spec.key, "bronze", removed(spec.missing_key_reason)))
        checks.append(check("duplicate_check", spec.key, "bronze", removed(spec.duplicate_reason)))
        for column in spec.columns:
            name = column.name
            if column.kind in (INTEGER, FLOAT):
                checks.append(check("cast_check", name, "silver", F.col(_lost(name))))
            if column.bounded:
                checks.append(check("range_check", name, "silver", F.col(_outside(name))))
            if column.accepted:
                unknown = F.col(_audit(name)).isNotNull()
                checks.append(check("accepted_values", name, "silver", unknown))
        for rule in spec.rules:
            if isinstance(rule, OutOfRange):
                checks.append(check("range_check", rule.column, "silver", removed(rule.reason)))
        for rule in spec.orphan_rules:
            broken = removed(rule.reason)
            checks.append(check("referential_integrity", rule.column, "silver", broken))
        checks.append(check("row_count", "*", "silver", reason.isNotNull()))
        return checks

    def quality(self, executed_at: datetime) -> DataFrame:
        return measure(self.rows, self.checks(), executed_at)


def decide(judged: Judged, staging: Staging, rejected: bool = True) -> Classified:
    """Add the last rule, not stored yet: of a key's surviving rows all but one are duplicates.

    Without `rejected`, rows that broke a rule before are left out. That is all Silver needs.

    Where the first row of a key stays and its place is a number, one aggregate counts the
    key's rows and finds it. Dates and wider places are of no use where keys are on one row.
    So they take two steps: the first shuffles nothing but keys and counts, and only rows of
    repeated keys bring their date and place along.
    """
    spec, rows = judged.spec, judged.rows
    one_step = not spec.latest_by and isinstance(rows.schema[ROW_ORDER].dataType, NumericType)
    survives = F.col(REASON).isNull()
    if not rejected:
        rows = rows.where(survives).withColumn(REASON, F.lit(None).cast("string"))
    narrow = [name for name in (spec.key, spec.latest_by, ROW_ORDER) if name]
    keys = rows.where(survives).select(*narrow)
    seen = Observation()
    if one_step:
        found = first_rows(keys, spec.key, ROW_ORDER, judged.total)
    else:
        found = repeat_counts(keys, spec.key, judged.total)
    counted = found.observe(
        seen, count_all().alias("keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows")
    )
    repeats = staging.pin(counted.drop("n_rows"), f"repeats-{spec.key}")
    surplus = seen.get["rows"] - seen.get["keys"]
    if surplus:
        winners = repeats
        if not one_step:
            winners = repeat_winners(keys, spec.key, repeats, ROW_ORDER, spec.latest_by)
            winners = staging.pin(winners, f"winners-{spec.key}")
        rows = flag_duplicates(rows, spec.key, winners, ROW_ORDER, "_duplicate", active=survives)
        fate = F.when(F.col("_duplicate"), F.lit(spec.duplicate_reason)).otherwise(F.col(REASON))
        rows = rows.withColumn(REASON, fate).drop("_duplicate")
    return Classified(spec, rows, judged.columns, unique_rows=judged.survivors - surplus)


def drop_repeats(judged: Judged, staging: Staging) -> Classified:
    """Decide which rows are duplicates, and store the decided rows with their counts."""
    decided = decide(judged, staging)
    observation = Observation()
    observed = decided.rows.observe(observation, *decided.to_count())
    stored = staging.pin(observed, f"classified-{judged.spec.name}", _codec(judged.spec))
    return replace(decided, rows=stored, counts=observation.get)


def classify(
    bronze: DataFrame, spec: TableSpec, parent_keys: dict[str, DataFrame], staging: Staging
) -> Classified:
    """Decide every row of a Bronze table; see `apply_rules` for the arguments."""
    return drop_repeats(apply_rules(bronze, spec, parent_keys, staging), staging)
