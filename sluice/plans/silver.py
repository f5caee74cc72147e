"""Silver: clean one table, check its contract, and only then publish its files."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from sluice.config import BRONZE, QUALITY, QUARANTINE, SILVER, table_path
from sluice.operators.contracts import (
    ContractError,
    contract_violations,
    shape_violations,
    unique_violations,
)
from sluice.operators.quality import long_format
from sluice.plans.classify import REJECT_REASON, Classified, apply_rules, classify, decide
from sluice.plans.specs import (
    CUSTOMERS,
    ORDER_ITEMS,
    ORDERS,
    PAYMENTS,
    PRODUCTS,
    REVIEWS,
    SPECS,
)
from sluice.sources.staging import Staging, together
from sluice.sources.store import delete, exists, move_folder, pending, read_keys, read_parquet, read_table

# Fixed value: the folder in which Spark puts rows whose partition column is null.
NO_REASON = "__HIVE_DEFAULT_PARTITION__"


def clean_customers(bronze: DataFrame, staging: Staging | None = None) -> Classified:
    return classify(bronze, CUSTOMERS, {}, staging or Staging(bronze.sparkSession))


def clean_products(bronze: DataFrame, staging: Staging | None = None) -> Classified:
    return classify(bronze, PRODUCTS, {}, staging or Staging(bronze.sparkSession))


def clean_orders(
    bronze: DataFrame, valid_customer_ids: DataFrame, staging: Staging | None = None
) -> Classified:
    parents = {"customers": valid_customer_ids}
    return classify(bronze, ORDERS, parents, staging or Staging(bronze.sparkSession))


def clean_order_items(
    bronze: DataFrame,
    valid_order_ids: DataFrame,
    valid_product_ids: DataFrame,
    staging: Staging | None = None,
) -> Classified:
    parents = {"orders": valid_order_ids, "products": valid_product_ids}
    return classify(bronze, ORDER_ITEMS, parents, staging or Staging(bronze.sparkSession))


def clean_payments(
    bronze: DataFrame, valid_order_ids: DataFrame, staging: Staging | None = None
) -> Classified:
    parents = {"orders": valid_order_ids}
    return classify(bronze, PAYMENTS, parents, staging or Staging(bronze.sparkSession))


def clean_reviews(
    bronze: DataFrame, valid_order_ids: DataFrame, staging: Staging | None = None
) -> Classified:
    parents = {"orders": valid_order_ids}
    return classify(bronze, REVIEWS, parents, staging or Staging(bronze.sparkSession))


def _gate(classified: Classified, counts: dict[str, int], written: DataFrame) -> None:
    """Raise if the written rows break the contract; `counts` are those of the write.

    Deduplication knows how many rows are left if every key is on one row. As long as that
    many were written, their keys are unique and need not be looked at again.
    """
    contract = classified.spec.contract
    rules = contract.row_rules(contract.names)
    found = [(column, rule, counts[f"rule_{i}"]) for i, (column, rule, _) in enumerate(rules) if counts[f"rule_{i}"]]
    proven = {classified.spec.key} if counts["silver"] == classified.unique_rows else set()
    open_fields = tuple(f for f in contract.fields if f.unique and f.name not in proven)
    if open_fields:
        found += [tuple(row) for row in unique_violations(written, open_fields).collect()]
    if found:
        raise ContractError(classified.spec.name, found)


def _write_fates(classified: Classified, path: str) -> dict[str, int]:
    """Write Silver and quarantine in one pass, a folder per reason; return what was counted."""
    observation = Observation()
    counted = replace(classified, rows=classified.rows.observe(observation, *classified.to_count()))
    counted.fates().write.mode("overwrite").partitionBy(REJECT_REASON).parquet(path)
    return observation.get


def build_silver(
    spark: SparkSession, root: str, name: str, staging: Staging, executed_at: datetime
) -> DataFrame:
    """Bronze to Silver for one table, with its quarantine and quality files.

    Rows are stored twice: judged, and then by their fate. What the second write counts
    is the table's quality and decides on its contract; if that fails, the table's earlier
    files stay as they were. Silver's folder is moved in; rejected rows, which are few and
    scattered over many tasks, are gathered into files of a sensible size. The judged rows go
    as soon as their fates are written.
    """
    with Staging(spark, staging.path) as own:
        return _build_silver(spark, root, name, own, executed_at)


def _build_silver(
    spark: SparkSession, root: str, name: str, staging: Staging, executed_at: datetime
) -> DataFrame:
    spec = SPECS[name]
    bronze = read_table(spark, root, BRONZE, name)
    parents = {p: read_keys(spark, root, p, SPECS[p].key) for p in spec.parents}
    classified = decide(apply_rules(bronze, spec, parents, staging, unique_parents=True), staging)

    shape = classified.silver()
    if shape_violations(shape, spec.contract):
        found = contract_violations(shape, spec.contract).collect()
        raise ContractError(name, [tuple(row) for row in found])

    targets = {layer: table_path(root, layer, name) for layer in (SILVER, QUARANTINE, QUALITY)}
    fates = pending(f"{targets[SILVER]}_fates")
    counts = _write_fates(classified, fates)
    staging.drop()  # from here on, all rows are those of the fates
    silver = f"{fates}/{REJECT_REASON}={NO_REASON}"
    if not exists(spark, silver):  # no row survived
        spark.createDataFrame([], shape.schema).write.parquet(silver)
    _gate(classified, counts, read_parquet(spark, silver, shape.schema))
    move_folder(spark, silver, pending(targets[SILVER]))
    rejected = classified.fates().schema
    jobs = [
        lambda: read_parquet(spark, fates, rejected).hint("rebalance").write.mode("overwrite").parquet(pending(targets[QUARANTINE])),
        lambda: _write_quality(spark, classified, counts, executed_at, pending(targets[QUALITY])),
    ]
    together(lambda job: job(), jobs)
    for target in targets.values():
        move_folder(spark, pending(target), target)
    delete(spark, fates)
    return read_table(spark, root, SILVER, name, shape.schema)


def _write_quality(
    spark: SparkSession, classified: Classified, counts: dict[str, int], executed_at: datetime, path: str
) -> None:
    checks = classified.checks()
    names = ["checked", *(f"failed_{i}" for i in range(len(checks)))]
    schema = ", ".join(f"{n} bigint" for n in names)
    totals = spark.createDataFrame([tuple(counts[n] for n in names)], schema)
    quality = long_format(totals, checks, executed_at).coalesce(1)  # a dozen rows
    quality.write.mode("overwrite").parquet(path)
