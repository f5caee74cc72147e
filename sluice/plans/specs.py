"""The six tables: how each is cleaned, what removes a row, and its contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from sluice.config import INGESTED_AT, SOURCE_FILE
from sluice.operators.contracts import Contract, Field

# Accepted product categories.
PRODUCT_CATEGORIES = (
    "automotive",
    "beauty",
    "books",
    "clothing",
    "electronics",
    "food",
    "furniture",
    "garden",
    "health",
    "home_appliances",
    "music",
    "office_supplies",
    "pet_shop",
    "sports",
    "toys",
)
# Accepted order statuses.
DELIVERED, SHIPPED, PROCESSING = "delivered", "shipped", "processing"
CANCELED, RETURNED = "canceled", "returned"
ORDER_STATUSES = (DELIVERED, SHIPPED, PROCESSING, CANCELED, RETURNED)
# Accepted payment types.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "pix")

TEXT, INTEGER, FLOAT, DATETIME = "text", "integer", "float", "datetime"


@dataclass(frozen=True)
class Column:
    """How one raw text column becomes a typed one.

    Values outside `low`..`high` are nulled and counted. Values not in `accepted` are
    nulled, and the row is copied to quarantine with its value under `reject_reason`.
    """

    name: str
    kind: str = TEXT
    case: str | None = None
    low: float | None = None
    high: float | None = None
    accepted: tuple[str, ...] | None = None
    reject_reason: str | None = None

    @property
    def bounded(self) -> bool:
        return self.low is not None or self.high is not None


@dataclass(frozen=True)
class OutOfRange:
    """Removes rows whose value lies outside the bounds; null passes."""

    column: str
    reason: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Missing:
    """Removes rows without a value."""

    column: str
    reason: str


@dataclass(frozen=True)
class Orphan:
    """Removes rows whose foreign key is not a key of the parent table; null passes."""

    column: str
    parent: str
    reason: str


Rule = OutOfRange | Missing | Orphan


@dataclass(frozen=True)
class TableSpec:
    """`rules` remove rows in this order; deduplication on the key always comes last.

    Kept of each key is the row with the latest `latest_by`, or the first one.
    """

    name: str
    key: str
    columns: tuple[Column, ...]
    rules: tuple[Rule, ...]
    descriptive: tuple[str, ...]
    contract: Contract
    latest_by: str | None = None

    @property
    def column_names(self) -> list[str]:
        return [column.name for column in self.columns]

    @property
    def orphan_rules(self) -> list[Orphan]:
        return [rule for rule in self.rules if isinstance(rule, Orphan)]

    @property
    def parents(self) -> list[str]:
        return [rule.parent for rule in self.orphan_rules]

    @property
    def missing_key_reason(self) -> str:
        return f"null_{self.key}"

    @property
    def duplicate_reason(self) -> str:
        return f"duplicate_{self.key}"


STRING, LONG, DOUBLE, TIMESTAMP = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()


def _contract(*fields: Field) -> Contract:
    lineage = (Field(SOURCE_FILE, STRING, nullable=False), Field(INGESTED_AT, TIMESTAMP, nullable=False))
    return Contract(fields + lineage)


def _key(name: str) -> Field:
    return Field(name, STRING, nullable=False, unique=True)


CUSTOMERS = TableSpec(
    name="customers",
    key="customer_id",
    columns=(
        Column("customer_id"),
        Column("customer_name"),
        Column("email", case="lower"),
        Column("city"),
        Column("state", case="upper"),
        Column("created_at", DATETIME),
    ),
    rules=(Missing("customer_id", "null_customer_id"),),
    latest_by="created_at",
    descriptive=("customer_name", "email", "city", "state"),
    contract=_contract(
        _key("customer_id"),
        Field("customer_name", STRING),
        Field("email", STRING),
        Field("city", STRING),
        Field("state", STRING),
        Field("created_at", TIMESTAMP, nullable=False),
    ),
)

PRODUCTS = TableSpec(
    name="products",
    key="product_id",
    columns=(
        Column("product_id"),
        Column("product_name"),
        Column("category", case="lower", accepted=PRODUCT_CATEGORIES, reject_reason="invalid_category"),
        Column("price", FLOAT, low=0),
        Column("weight_kg", FLOAT),
    ),
    rules=(Missing("product_id", "null_product_id"),),
    descriptive=("product_name", "category", "price", "weight_kg"),
    contract=_contract(
        _key("product_id"),
        Field("product_name", STRING),
        Field("category", STRING, isin=PRODUCT_CATEGORIES),
        Field("price", DOUBLE, ge=0),
        Field("weight_kg", DOUBLE, ge=0),
    ),
)

ORDERS = TableSpec(
    name="orders",
    key="order_id",
    columns=(
        Column("order_id"),
        Column("customer_id"),
        Column("status", case="lower", accepted=ORDER_STATUSES, reject_reason="invalid_status"),
        Column("order_date", DATETIME),
        Column("approved_at", DATETIME),
        Column("delivered_at", DATETIME),
    ),
    rules=(
        Orphan("customer_id", "customers", "orphan_customer"),
        Missing("order_id", "null_order_id"),
    ),
    latest_by="order_date",
    descriptive=("status", "order_date", "approved_at", "delivered_at"),
    contract=_contract(
        _key("order_id"),
        Field("customer_id", STRING, nullable=False),
        Field("status", STRING, isin=ORDER_STATUSES),
        Field("order_date", TIMESTAMP),
        Field("approved_at", TIMESTAMP),
        Field("delivered_at", TIMESTAMP),
    ),
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    key="item_id",
    columns=(
        Column("item_id"),
        Column("order_id"),
        Column("product_id"),
        Column("quantity", INTEGER),
        Column("unit_price", FLOAT),
        Column("freight_value", FLOAT),
    ),
    rules=(
        OutOfRange("quantity", "invalid_quantity", low=1),
        Missing("unit_price", "null_unit_price"),
        Orphan("order_id", "orders", "orphan_order"),
        Orphan("product_id", "products", "orphan_product"),
        Missing("item_id", "null_item_id"),
    ),
    descriptive=("quantity", "unit_price", "freight_value"),
    contract=_contract(
        _key("item_id"),
        Field("order_id", STRING, nullable=False),
        Field("product_id", STRING, nullable=False),
        Field("quantity", LONG, nullable=False, gt=0),
        Field("unit_price", DOUBLE, nullable=False, ge=0),
        Field("freight_value", DOUBLE, ge=0),
    ),
)

PAYMENTS = TableSpec(
    name="payments",
    key="payment_id",
    columns=(
        Column("payment_id"),
        Column("order_id"),
        Column("payment_type", case="lower", accepted=PAYMENT_TYPES, reject_reason="invalid_payment_type"),
        Column("installments", INTEGER),
        Column("amount", FLOAT),
    ),
    rules=(
        OutOfRange("amount", "invalid_amount", low=0),
        Orphan("order_id", "orders", "orphan_order"),
        Missing("payment_id", "null_payment_id"),
    ),
    descriptive=("payment_type", "installments", "amount"),
    contract=_contract(
        _key("payment_id"),
        Field("order_id", STRING, nullable=False),
        Field("payment_type", STRING, isin=PAYMENT_TYPES),
        Field("installments", LONG),
        Field("amount", DOUBLE, nullable=False, ge=0),
    ),
)

REVIEWS = TableSpec(
    name="reviews",
    key="review_id",
    columns=(
        Column("review_id"),
        Column("order_id"),
        Column("score", INTEGER, low=1, high=5),
        Column("title"),
        Column("comment"),
        Column("created_at", DATETIME),
    ),
    rules=(
        Orphan("order_id", "orders", "orphan_order"),
        Missing("review_id", "null_review_id"),
    ),
    latest_by="created_at",
    descriptive=("score", "title", "comment"),
    contract=_contract(
        _key("review_id"),
        Field("order_id", STRING, nullable=False),
        Field("score", LONG, ge=1, le=5),
        Field("title", STRING),
        Field("comment", STRING),
        Field("created_at", TIMESTAMP, nullable=False),
    ),
)

SPECS = {spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS, REVIEWS)}
