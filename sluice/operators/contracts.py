"""Contracts: what a finished table must look like, and the rows that break it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.quality import count_true

VIOLATIONS_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("failed", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Field:
    """A column and its rules. Bounds and accepted values never apply to null."""

    name: str
    dtype: T.DataType
    nullable: bool = True
    unique: bool = False
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    isin: tuple[str, ...] | None = None

    def rules(self) -> list[tuple[str, Column]]:
        """(rule, condition under which a row breaks it)."""
        value = F.col(self.name)
        broken = []
        if not self.nullable:
            broken.append(("not_null", value.isNull()))
        if self.ge is not None:
            broken.append((f"ge({self.ge})", value < self.ge))
        if self.gt is not None:
            broken.append((f"gt({self.gt})", value <= self.gt))
        if self.le is not None:
            broken.append((f"le({self.le})", value > self.le))
        if self.isin is not None:
            broken.append(("isin", value.isNotNull() & ~value.isin(list(self.isin))))
        return broken


@dataclass(frozen=True)
class Contract:
    """The exact columns of a table. Extra, missing or differently typed ones break it."""

    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dtype) for f in self.fields])

    def row_rules(self, columns: list[str]) -> list[tuple[str, str, Column]]:
        """(column, rule, broken) for every rule on the given columns but uniqueness."""
        return [
            (field.name, rule, broken)
            for field in self.fields
            if field.name in columns
            for rule, broken in field.rules()
        ]


class ContractError(ValueError):
    """Raised with every violation of a table at once."""

    def __init__(self, table: str, violations: list[tuple[str, str, int]]) -> None:
        self.table = table
        self.violations = violations
        listing = "; ".join(f"{column}: {rule} ({failed} rows)" for column, rule, failed in violations)
        super().__init__(f"{table} breaks its contract: {listing}")


def shape_violations(df: DataFrame, contract: Contract) -> list[tuple[str, str, int]]:
    """Columns that are missing, extra or of another type; looks at the schema only."""
    actual = {field.name: field.dataType for field in df.schema}
    expected = {field.name: field.dtype for field in contract.fields}
    found = [(name, "column_in_dataframe", 0) for name in expected if name not in actual]
    found += [(name, "column_in_schema", 0) for name in actual if name not in expected]
    found += [
        (name, f"dtype({dtype.simpleString()})", 0)
        for name, dtype in expected.items()
        if name in actual and actual[name] != dtype
    ]
    return found


def usable_columns(df: DataFrame, contract: Contract) -> list[str]:
    """Contract columns that exist with the right type, so that rules can run on them."""
    broken = {column for column, _, _ in shape_violations(df, contract)}
    return [name for name in contract.names if name not in broken]


def repeated_rows(df: DataFrame, column: str) -> DataFrame:
    """One row: how many rows share their value of `column` with another row."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed"))


def unique_violations(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Violations of unique columns, each by grouping that one column."""
    result = df.sparkSession.createDataFrame([], VIOLATIONS_SCHEMA)
    for field in fields:
        repeated = repeated_rows(df, field.name).select(
            F.lit(field.name).alias("column"), F.lit("unique").alias("check"), "failed"
        )
        result = result.unionByName(repeated)
    return result.where("failed > 0")


def uniqueness_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Violations of the contract's unique columns only, as far as they are there."""
    usable = usable_columns(df, contract)
    return unique_violations(df, tuple(f for f in contract.fields if f.unique and f.name in usable))


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Every violation as (column, check, failed), empty for a valid table.

    All row rules share one aggregate. Violations of the shape carry 0 failed rows.
    """
    spark = df.sparkSession
    shape = spark.createDataFrame(shape_violations(df, contract), VIOLATIONS_SCHEMA)
    rules = contract.row_rules(usable_columns(df, contract))
    if rules:
        counts = df.agg(*(count_true(broken).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)))
        listed = F.array(
            *(
                F.struct(
                    F.lit(column).alias("column"),
                    F.lit(rule).alias("check"),
                    F.col(f"r{i}").alias("failed"),
                )
                for i, (column, rule, _) in enumerate(rules)
            )
        )
        rows = counts.select(F.explode(listed).alias("v")).select("v.*").where("failed > 0")
        shape = shape.unionByName(rows)
    return shape.unionByName(uniqueness_violations(df, contract))


def validate(df: DataFrame, contract: Contract, table: str = "table") -> None:
    """Raise a ContractError listing all violations, if there are any."""
    found = contract_violations(df, contract).collect()  # at most one row per rule
    if found:
        raise ContractError(table, [tuple(row) for row in found])
