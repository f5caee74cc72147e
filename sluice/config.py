"""Names of the tables and layers, and where each one lives under a root URI."""

from __future__ import annotations

# Parents come before the tables whose foreign keys point at them.
TABLES = ("customers", "products", "orders", "order_items", "payments", "reviews")

RAW, BRONZE, SILVER, GOLD = "raw", "bronze", "silver", "gold"
QUARANTINE, QUALITY = "quarantine", "quality"

GOLD_TABLES = (
    "gold_sales_by_state",
    "gold_product_performance",
    "gold_customer_segments",
    "gold_monthly_kpis",
)

# Lineage columns every Bronze and Silver row carries.
SOURCE_FILE, INGESTED_AT = "_source_file", "_ingested_at"
# Position of the row in its source; kept in Bronze, dropped before the contract.
ROW_ORDER = "_ord"


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def raw_path(root: str, name: str) -> str:
    """A single CSV file or a directory of them; Spark reads both the same way."""
    return f"{root.rstrip('/')}/{RAW}/{name}.csv"
