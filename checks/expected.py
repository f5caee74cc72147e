"""Expected results by query name."""

from __future__ import annotations

from checks import oracle as o
from checks.fixtures import raw_sql


def _raw(name: str, query: str) -> str:
    return o.with_raw([name], query)


_CATEGORY = f"lower({o.text('category')})"
_PRODUCTS_TEXT = (
    f"{o.text('product_id')} AS product_id, {o.text('product_name')} AS product_name, price, weight_kg"
)
_LATEST = f"""SELECT _ord, order_id, status, d AS order_date FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY d DESC NULLS LAST, _ord) AS rn
  FROM (SELECT *, {o.timestamp('order_date')} AS d FROM raw_orders)) WHERE rn"""
_FIRST = """SELECT _ord, item_id, product_id FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY _ord) AS rn FROM raw_order_items) WHERE rn"""
_MISSING_ORDER = "order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL)"
_QUANTITY = o.integer("quantity")


# The rules of every table's contract beside its unique key.
CONTRACT_RULES = {
    "customers": [("customer_id", "not_null", "customer_id IS NULL"), ("created_at", "not_null", "created_at IS NULL")],
    "products": [
        ("product_id", "not_null", "product_id IS NULL"),
        ("category", "isin", f"category NOT IN {o.CATEGORIES}"),
        ("price", "ge(0)", "price < 0"),
        ("weight_kg", "ge(0)", "weight_kg < 0"),
    ],
    "orders": [
        ("order_id", "not_null", "order_id IS NULL"),
        ("customer_id", "not_null", "customer_id IS NULL"),
        ("status", "isin", f"status NOT IN {o.STATUSES}"),
    ],
    "order_items": [
        ("item_id", "not_null", "item_id IS NULL"),
        ("order_id", "not_null", "order_id IS NULL"),
        ("product_id", "not_null", "product_id IS NULL"),
        ("quantity", "not_null", "quantity IS NULL"),
        ("quantity", "gt(0)", "quantity <= 0"),
        ("unit_price", "not_null", "unit_price IS NULL"),
        ("unit_price", "ge(0)", "unit_price < 0"),
        ("freight_value", "ge(0)", "freight_value < 0"),
    ],
    "payments": [
        ("payment_id", "not_null", "payment_id IS NULL"),
        ("order_id", "not_null", "order_id IS NULL"),
        ("payment_type", "isin", f"payment_type NOT IN {o.PAYMENT_TYPES}"),
        ("amount", "not_null", "amount IS NULL"),
        ("amount", "ge(0)", "amount < 0"),
    ],
    "reviews": [
        ("review_id", "not_null", "review_id IS NULL"),
        ("order_id", "not_null", "order_id IS NULL"),
        ("score", "ge(1)", "score < 1"),
        ("score", "le(5)", "score > 5"),
        ("created_at", "not_null", "created_at IS NULL"),
    ],
}


def _violations(name: str, table: str, more: tuple[str, ...] = ()) -> str:
    counted = [
        f"""SELECT '{column}' AS "column", '{rule}' AS "check",
          (count(*) FILTER (WHERE {broken}))::BIGINT AS failed FROM {table}"""
        for column, rule, broken in CONTRACT_RULES[name]
    ]
    repeated = f"""SELECT '{o.KEYS[name]}', 'unique', sum(n)::BIGINT
      FROM (SELECT count(*) AS n FROM {table} GROUP BY {o.KEYS[name]}) WHERE n > 1"""
    return f"SELECT * FROM ({' UNION ALL '.join([*counted, repeated])}) WHERE failed > 0" + "".join(more)


def _typed_violations(name: str) -> str:
    return f"WITH raw_{name} AS ({raw_sql(name)}), typed AS ({o.NORMALIZED[name]}) {_violations(name, 'typed')}"


_SHAPE = """ UNION ALL SELECT * FROM (VALUES
  ('_source_file', 'column_in_dataframe', 0::BIGINT), ('_ingested_at', 'column_in_dataframe', 0),
  ('_ord', 'column_in_schema', 0), ('order_date', 'dtype(timestamp_ntz)', 0),
  ('approved_at', 'dtype(timestamp_ntz)', 0), ('delivered_at', 'dtype(timestamp_ntz)', 0))"""


def _report(rows: str, checked: str, failed: str) -> str:
    return f"SELECT *, {o.percent(failed, checked)} AS pct_failed FROM ({rows})"


_NULL_ROWS = " UNION ALL ".join(
    f"""SELECT 'null_check' AS check_name, '{name}' AS "table", '{column}' AS "column",
      count(*)::BIGINT AS records_checked, (count(*) FILTER (WHERE {column} IS NULL))::BIGINT AS records_failed,
      'bronze' AS stage FROM raw_{name}"""
    for name in o.KEYS
    for column in o.COLUMNS[name]
)
_DUPLICATE_ROWS = " UNION ALL ".join(
    f"""SELECT 'duplicate_check' AS check_name, '{name}' AS "table", '{key}' AS "column",
      count(*)::BIGINT AS records_checked, (count(*) - count(DISTINCT coalesce({key}, '<null>')))::BIGINT AS records_failed,
      'bronze' AS stage FROM raw_{name}"""
    for name, key in o.KEYS.items()
)

EXPECTED: dict[str, str] = {
    "strip_strings": _raw(
        "customers",
        "SELECT _ord, "
        + ", ".join(f"{o.text(c)} AS {c}" for c in ("customer_id", "customer_name", "email", "city", "state"))
        + " FROM raw_customers",
    ),
    "lowercase": _raw("customers", "SELECT _ord, lower(email) AS email FROM raw_customers"),
    "uppercase": _raw("customers", "SELECT _ord, upper(state) AS state FROM raw_customers"),
    "parse_datetime": _raw(
        "orders",
        "SELECT _ord, "
        + ", ".join(f"{o.timestamp(c)} AS {c}" for c in ("order_date", "approved_at", "delivered_at"))
        + " FROM raw_orders",
    ),
    "cast_float": _raw(
        "products",
        f"""SELECT _ord, {o.double('price')} AS price,
          (SELECT count(*) FROM raw_products WHERE {o.lost('price', o.double('price'))})::BIGINT AS n_failed
          FROM raw_products""",
    ),
    "cast_int": _raw(
        "payments",
        f"""SELECT _ord, {o.integer('installments')} AS installments,
          (SELECT count(*) FROM raw_payments WHERE {o.lost('installments', o.integer('installments'))})::BIGINT AS n_failed
          FROM raw_payments""",
    ),
    "parse_datetime_pattern": _raw(
        "orders",
        f"""SELECT zone, _ord, date_trunc('day', {o.timestamp('order_date')})::TIMESTAMP AS day
          FROM raw_orders CROSS JOIN (VALUES ('America/Sao_Paulo'), ('UTC')) z(zone)""",
    ),
    "nullify_outside_range": _raw(
        "reviews",
        f"""SELECT _ord, CASE WHEN s BETWEEN 1 AND 5 THEN s END AS score,
          (count(*) FILTER (WHERE s NOT BETWEEN 1 AND 5) OVER ())::BIGINT AS n_nulled
          FROM (SELECT _ord, {o.integer('score')} AS s FROM raw_reviews)""",
    ),
    "split_outside_range_kept": _raw(
        "order_items",
        f"SELECT * FROM (SELECT _ord, item_id, {_QUANTITY} AS quantity FROM raw_order_items) WHERE quantity IS NULL OR quantity >= 1",
    ),
    "split_outside_range_rejected": _raw(
        "order_items",
        f"SELECT * FROM (SELECT _ord, item_id, {_QUANTITY} AS quantity FROM raw_order_items) WHERE quantity < 1",
    ),
    "nullify_not_in_set": _raw(
        "products",
        f"SELECT _ord, {_PRODUCTS_TEXT}, CASE WHEN {_CATEGORY} IN {o.CATEGORIES} THEN {_CATEGORY} END AS category FROM raw_products",
    ),
    "nullify_not_in_set_audit": _raw(
        "products",
        f"SELECT _ord, {_PRODUCTS_TEXT}, {_CATEGORY} AS category FROM raw_products WHERE {_CATEGORY} NOT IN {o.CATEGORIES}",
    ),
    "drop_null_keys_kept": _raw(
        "customers", "SELECT _ord, customer_id, customer_name FROM raw_customers WHERE customer_id IS NOT NULL"
    ),
    "drop_null_keys_rejected": _raw(
        "customers", "SELECT _ord, customer_id, customer_name FROM raw_customers WHERE customer_id IS NULL"
    ),
    "split_orphans_kept": o.with_raw(
        ["orders", "order_items"],
        f"SELECT _ord, item_id, order_id FROM raw_order_items WHERE NOT coalesce({_MISSING_ORDER}, false)",
    ),
    "split_orphans_orphans": o.with_raw(
        ["orders", "order_items"], f"SELECT _ord, item_id, order_id FROM raw_order_items WHERE {_MISSING_ORDER}"
    ),
    "dedup_latest": _raw("orders", f"{_LATEST} = 1"),
    "dedup_latest_removed": _raw("orders", f"{_LATEST} > 1"),
    "dedup_first": _raw("order_items", f"{_FIRST} = 1"),
    "dedup_first_removed": _raw("order_items", f"{_FIRST} > 1"),
    "quarantine_union": _raw(
        "products",
        f"""SELECT _ord, product_name, NULL AS product_id, NULL AS category, 'null_product_id' AS reject_reason
          FROM raw_products WHERE product_id IS NULL
          UNION ALL SELECT _ord, NULL, {o.text('product_id')}, {_CATEGORY}, 'invalid_category'
          FROM raw_products WHERE {_CATEGORY} NOT IN {o.CATEGORIES}""",
    ),
    **{f"silver_{name}": o.silver(name) for name in o.KEYS},
    **{f"quarantine_{name}": o.quarantine(name) for name in o.KEYS},
    **{f"quality_{name}": o.quality([name]) for name in o.KEYS},
    "quality_checks": o.quality(list(o.KEYS)),
    "null_counts": o.with_raw(list(o.KEYS), _report(_NULL_ROWS, "records_checked", "records_failed")),
    "duplicate_check": o.with_raw(list(o.KEYS), _report(_DUPLICATE_ROWS, "records_checked", "records_failed")),
    "accepted_values_check": _raw(
        "products",
        o.check_row("accepted_values", "products", "category", "bronze", "raw_products", f"category NOT IN {o.CATEGORIES}"),
    ),
    "row_count_check": _raw(
        "customers", o.check_row("row_count", "customers", "*", "silver", "raw_customers", "customer_id IS NULL")
    ),
    **{f"contract_violations_{name}": o.with_tables([name], _violations(name, f"silver_{name}")) for name in o.KEYS},
    **{f"contract_violations_typed_{name}": _typed_violations(name) for name in o.KEYS},
    "contract_shape": f"WITH raw_orders AS ({raw_sql('orders')}) {_violations('orders', 'raw_orders', (_SHAPE,))}",
    "contract_raises": _typed_violations("order_items"),
    "contract_gate": o.with_tables(
        ["customers"], """SELECT 'customers' AS "table", count(*)::BIGINT AS rows, true AS raised FROM silver_customers"""
    ),
    "bronze_ingest": _raw(
        "customers", "SELECT * EXCLUDE (_ord), 'customers.csv' AS _source_file FROM raw_customers"
    ),
    "parquet_round_trip": raw_sql("payments"),
    "sales_lines": o.SALES_LINES,
    "sales_by_state": o.SALES_BY_STATE,
    "product_performance": o.PRODUCT_PERFORMANCE,
    "customer_segments": o.CUSTOMER_SEGMENTS,
    "rfm_cut_points": o.RFM_CUT_POINTS,
    "monthly_kpis": o.MONTHLY_KPIS,
    "published_tables": o.published(),
    "layer_row_counts": o.layer_counts(),
    "profile_distinct_values": _raw(
        "products", "SELECT DISTINCT category FROM raw_products WHERE category IS NOT NULL"
    ),
    "sales_by_state_order": f"""SELECT row_number() OVER (ORDER BY revenue DESC, state) AS place, *
      FROM ({o.SALES_BY_STATE})""",
    "monthly_kpis_order": f"SELECT row_number() OVER (ORDER BY month) AS place, * FROM ({o.MONTHLY_KPIS})",
    "profile_sample": """SELECT count(*) AS table_rows, 0::BIGINT AS foreign_rows, 0::BIGINT AS changed_rows,
      true AS share_fits FROM orders""",
    "profile_head": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "profile_value_counts": _raw(
        "orders", "SELECT lower(trim(status)) AS status, count(*)::BIGINT AS count FROM raw_orders GROUP BY 1"
    ),
}
