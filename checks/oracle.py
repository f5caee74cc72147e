"""The expected results as SQL over the test tables, written step by step.

Nothing here follows the Spark plans: the steps filter one after the other and rank
with windows, in the order the cleaning rules are stated.
"""

from __future__ import annotations

from checks.fixtures import raw_sql

INT = r"'^[+-]?[0-9]+\z'"
FLOAT = r"'^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\z'"
DATETIME = r"'^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z'"

# What is accepted as a category, an order's status, a kind of payment.
CATEGORIES = (
    "('automotive','beauty','books','clothing','electronics','food','furniture','garden',"
    "'health','home_appliances','music','office_supplies','pet_shop','sports','toys')"
)
STATUSES = "('delivered','shipped','processing','canceled','returned')"
PAYMENT_TYPES = "('credit_card','boleto','voucher','debit_card','pix')"


def text(c: str) -> str:
    return f"nullif(trim({c}), '')"


def integer(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {INT}) THEN TRY_CAST({c} AS BIGINT) END"


def double(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {FLOAT}) THEN TRY_CAST({c} AS DOUBLE) END"


def timestamp(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {DATETIME}) THEN try_strptime({c}, '%Y-%m-%d %H:%M:%S') END"


def lost(raw: str, casted: str) -> str:
    return f"({raw} IS NOT NULL AND ({casted}) IS NULL)"


def cents(value: str) -> str:
    """Two decimals, ties of the scaled double to even."""
    return f"round_even(({value}) * 100, 0)::DOUBLE / 100"


def money(condition: str = "true") -> str:
    amount = "CAST(quantity * unit_price AS DECIMAL(28,10))"
    return f"CAST(coalesce(sum({amount}) FILTER (WHERE {condition}), 0) AS DOUBLE)"


# Normalized tables: cleaned columns, raw text of counted columns, audited original.
NORMALIZED = {
    "customers": f"""SELECT _ord, {text('customer_id')} AS customer_id, {text('customer_name')} AS customer_name,
      lower({text('email')}) AS email, {text('city')} AS city, upper({text('state')}) AS state,
      {timestamp('created_at')} AS created_at FROM raw_customers""",
    "products": f"""SELECT _ord, product_id, product_name, CASE WHEN cat IN {CATEGORIES} THEN cat END AS category,
      CASE WHEN p >= 0 THEN p END AS price, weight_kg,
      CASE WHEN cat NOT IN {CATEGORIES} THEN cat END AS audit
      FROM (SELECT _ord, {text('product_id')} AS product_id, {text('product_name')} AS product_name,
        lower({text('category')}) AS cat, {double('price')} AS p, {double('weight_kg')} AS weight_kg FROM raw_products)""",
    "orders": f"""SELECT _ord, order_id, customer_id, CASE WHEN st IN {STATUSES} THEN st END AS status,
      order_date, approved_at, delivered_at, CASE WHEN st NOT IN {STATUSES} THEN st END AS audit
      FROM (SELECT _ord, {text('order_id')} AS order_id, {text('customer_id')} AS customer_id, lower({text('status')}) AS st,
        {timestamp('order_date')} AS order_date, {timestamp('approved_at')} AS approved_at,
        {timestamp('delivered_at')} AS delivered_at FROM raw_orders)""",
    "order_items": f"""SELECT _ord, {text('item_id')} AS item_id, {text('order_id')} AS order_id,
      {text('product_id')} AS product_id, {integer('quantity')} AS quantity, {double('unit_price')} AS unit_price,
      {double('freight_value')} AS freight_value FROM raw_order_items""",
    "payments": f"""SELECT _ord, payment_id, order_id, CASE WHEN ty IN {PAYMENT_TYPES} THEN ty END AS payment_type,
      installments, amount, CASE WHEN ty NOT IN {PAYMENT_TYPES} THEN ty END AS audit
      FROM (SELECT _ord, {text('payment_id')} AS payment_id, {text('order_id')} AS order_id,
        lower({text('payment_type')}) AS ty, {integer('installments')} AS installments,
        {double('amount')} AS amount FROM raw_payments)""",
    "reviews": f"""SELECT _ord, review_id, order_id, CASE WHEN s BETWEEN 1 AND 5 THEN s END AS score, title, comment, created_at
      FROM (SELECT _ord, {text('review_id')} AS review_id, {text('order_id')} AS order_id, {integer('score')} AS s,
        {text('title')} AS title, {text('comment')} AS comment, {timestamp('created_at')} AS created_at FROM raw_reviews)""",
}

KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "item_id",
    "payments": "payment_id",
    "reviews": "review_id",
}

COLUMNS = {
    "customers": ["customer_id", "customer_name", "email", "city", "state", "created_at"],
    "products": ["product_id", "product_name", "category", "price", "weight_kg"],
    "orders": ["order_id", "customer_id", "status", "order_date", "approved_at", "delivered_at"],
    "order_items": ["item_id", "order_id", "product_id", "quantity", "unit_price", "freight_value"],
    "payments": ["payment_id", "order_id", "payment_type", "installments", "amount"],
    "reviews": ["review_id", "order_id", "score", "title", "comment", "created_at"],
}

DEDUP_ORDER = {
    "customers": "created_at DESC NULLS LAST, _ord",
    "products": "_ord",
    "orders": "order_date DESC NULLS LAST, _ord",
    "order_items": "_ord",
    "payments": "_ord",
    "reviews": "created_at DESC NULLS LAST, _ord",
}


def orphan(fk: str, parent: str) -> str:
    key = KEYS[parent]
    return f"(n.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM silver_{parent} p WHERE p.{key} = n.{fk}))"


# Removal steps in order, each as (condition on n, reason).
STEPS = {
    "customers": [("n.customer_id IS NULL", "null_customer_id")],
    "products": [("n.product_id IS NULL", "null_product_id")],
    "orders": [(orphan("customer_id", "customers"), "orphan_customer"), ("n.order_id IS NULL", "null_order_id")],
    "order_items": [
        ("n.quantity < 1", "invalid_quantity"),
        ("n.unit_price IS NULL", "null_unit_price"),
        (orphan("order_id", "orders"), "orphan_order"),
        (orphan("product_id", "products"), "orphan_product"),
        ("n.item_id IS NULL", "null_item_id"),
    ],
    "payments": [
        ("n.amount < 0", "invalid_amount"),
        (orphan("order_id", "orders"), "orphan_order"),
        ("n.payment_id IS NULL", "null_payment_id"),
    ],
    "reviews": [(orphan("order_id", "orders"), "orphan_order"), ("n.review_id IS NULL", "null_review_id")],
}

AUDITS = {
    "products": ("category", "invalid_category"),
    "orders": ("status", "invalid_status"),
    "payments": ("payment_type", "invalid_payment_type"),
}

PARENTS = {"orders": ["customers"], "order_items": ["orders", "products"], "payments": ["orders"], "reviews": ["orders"]}


def table_ctes(name: str) -> list[str]:
    """raw_, norm_, judged_ and silver_ of one table, assuming its parents' silver_."""
    key = KEYS[name]
    steps = " ".join(f"WHEN {condition} THEN '{reason}'" for condition, reason in STEPS[name])
    columns = ", ".join(COLUMNS[name])
    return [
        f"raw_{name} AS ({raw_sql(name)})",
        f"norm_{name} AS ({NORMALIZED[name]})",
        f"step_{name} AS (SELECT n.*, CASE {steps} END AS reason FROM norm_{name} n)",
        f"""judged_{name} AS (
          SELECT * FROM step_{name} WHERE reason IS NOT NULL
          UNION ALL
          SELECT * EXCLUDE (rn) REPLACE (CASE WHEN rn > 1 THEN 'duplicate_{key}' END AS reason) FROM (
            SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {DEDUP_ORDER[name]}) AS rn
            FROM step_{name} WHERE reason IS NULL))""",
        f"silver_{name} AS (SELECT {columns}, '{name}.csv' AS _source_file FROM judged_{name} WHERE reason IS NULL)",
    ]


def with_tables(names: list[str], query: str) -> str:
    """A query with everything up to the Silver of the given tables as CTEs."""
    needed: list[str] = []

    def add(name: str) -> None:
        for parent in PARENTS.get(name, []):
            add(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    ctes = [cte for name in needed for cte in table_ctes(name)]
    return f"WITH {', '.join(ctes)} {query}"


def with_raw(names: list[str], query: str) -> str:
    ctes = ", ".join(f"raw_{name} AS ({raw_sql(name)})" for name in names)
    return f"WITH {ctes} {query}"


def silver(name: str) -> str:
    return with_tables([name], f"SELECT * FROM silver_{name}")


def quarantine_select(name: str) -> str:
    columns = ", ".join(COLUMNS[name])
    lineage = f"'{name}.csv' AS _source_file"
    query = f"SELECT {columns}, {lineage}, reason AS reject_reason FROM judged_{name} WHERE reason IS NOT NULL"
    if name in AUDITS:
        column, reason = AUDITS[name]
        original = ", ".join(f"audit AS {c}" if c == column else c for c in COLUMNS[name])
        query += f" UNION ALL SELECT {original}, {lineage}, '{reason}' FROM judged_{name} WHERE audit IS NOT NULL"
    return query


def quarantine(name: str) -> str:
    return with_tables([name], quarantine_select(name))


# Quality checks as (check_name, column, stage, source, failing condition).
DESCRIPTIVE = {
    "customers": ["customer_name", "email", "city", "state"],
    "products": ["product_name", "category", "price", "weight_kg"],
    "orders": ["status", "order_date", "approved_at", "delivered_at"],
    "order_items": ["quantity", "unit_price", "freight_value"],
    "payments": ["payment_type", "installments", "amount"],
    "reviews": ["score", "title", "comment"],
}
EXTRA_CHECKS = {
    "customers": [],
    "products": [
        ("cast_check", "price", "raw", lost("price", double("price"))),
        ("cast_check", "weight_kg", "raw", lost("weight_kg", double("weight_kg"))),
        ("range_check", "price", "raw", f"({double('price')}) < 0"),
        ("accepted_values", "category", "judged", "audit IS NOT NULL"),
    ],
    "orders": [
        ("accepted_values", "status", "judged", "audit IS NOT NULL"),
        ("referential_integrity", "customer_id", "judged", "reason = 'orphan_customer'"),
    ],
    "order_items": [
        ("cast_check", "quantity", "raw", lost("quantity", integer("quantity"))),
        ("cast_check", "unit_price", "raw", lost("unit_price", double("unit_price"))),
        ("cast_check", "freight_value", "raw", lost("freight_value", double("freight_value"))),
        ("range_check", "quantity", "judged", "reason = 'invalid_quantity'"),
        ("referential_integrity", "order_id", "judged", "reason = 'orphan_order'"),
        ("referential_integrity", "product_id", "judged", "reason = 'orphan_product'"),
    ],
    "payments": [
        ("cast_check", "installments", "raw", lost("installments", integer("installments"))),
        ("cast_check", "amount", "raw", lost("amount", double("amount"))),
        ("accepted_values", "payment_type", "judged", "audit IS NOT NULL"),
        ("range_check", "amount", "judged", "reason = 'invalid_amount'"),
        ("referential_integrity", "order_id", "judged", "reason = 'orphan_order'"),
    ],
    "reviews": [
        ("cast_check", "score", "raw", lost("score", integer("score"))),
        ("range_check", "score", "raw", f"({integer('score')}) NOT BETWEEN 1 AND 5"),
        ("referential_integrity", "order_id", "judged", "reason = 'orphan_order'"),
    ],
}


def percent(failed: str, checked: str) -> str:
    """Two decimals of the double's exact binary value, which is what printing does."""
    return f"printf('%.2f', 100.0::DOUBLE * {failed} / {checked})::DOUBLE"


def check_row(check: str, table: str, column: str, stage: str, source: str, failing: str) -> str:
    return f"""SELECT '{check}' AS check_name, '{table}' AS "table", '{column}' AS "column",
      count(*)::BIGINT AS records_checked, (count(*) FILTER (WHERE {failing}))::BIGINT AS records_failed,
      {percent(f"count(*) FILTER (WHERE {failing})", "count(*)")} AS pct_failed,
      '{stage}' AS stage FROM {source}"""


def quality_select(name: str) -> str:
    key = KEYS[name]
    checks = [("null_check", c, "bronze", f"raw_{name}", f"{c} IS NULL") for c in DESCRIPTIVE[name]]
    checks.append(("null_check", key, "bronze", f"judged_{name}", f"reason = 'null_{key}'"))
    checks.append(("duplicate_check", key, "bronze", f"judged_{name}", f"reason = 'duplicate_{key}'"))
    checks += [(n, c, "silver", f"{s}_{name}", f) for n, c, s, f in EXTRA_CHECKS[name]]
    checks.append(("row_count", "*", "silver", f"judged_{name}", "reason IS NOT NULL"))
    return " UNION ALL ".join(check_row(n, name, c, stage, s, f) for n, c, stage, s, f in checks)


def quality(names: list[str]) -> str:
    return with_tables(names, " UNION ALL ".join(quality_select(name) for name in names))


SALES = "silver_order_items i JOIN silver_orders o USING (order_id) WHERE o.status <> 'canceled'"

SALES_LINES = with_tables(
    ["order_items"],
    f"""SELECT i.item_id, order_id, i.product_id, i.quantity, i.unit_price, i.freight_value,
      i._source_file, o.customer_id, o.status, o.order_date, i.quantity * i.unit_price AS line_revenue FROM {SALES}""",
)

SALES_BY_STATE = with_tables(
    ["order_items"],
    f"""SELECT state, revenue, num_orders, {cents('revenue / num_orders')} AS avg_ticket FROM (
      SELECT coalesce(c.state, 'UNKNOWN') AS state, {cents(money())} AS revenue,
        count(DISTINCT order_id)::BIGINT AS num_orders
      FROM (SELECT order_id, customer_id, quantity, unit_price FROM {SALES}) s
      JOIN silver_customers c USING (customer_id) GROUP BY 1)""",
)

PRODUCT_PERFORMANCE = with_tables(
    ["order_items", "reviews"],
    f"""SELECT p.product_id, p.product_name, p.category, s.units_sold, s.revenue, s.num_orders, r.return_rate, v.avg_review_score
      FROM silver_products p
      JOIN (SELECT product_id, sum(quantity)::BIGINT AS units_sold, {cents(money())} AS revenue,
              count(DISTINCT order_id)::BIGINT AS num_orders FROM {SALES} GROUP BY product_id) s USING (product_id)
      LEFT JOIN (SELECT product_id, {cents('''(count(DISTINCT CASE WHEN o.status = 'returned' THEN order_id END)::DOUBLE
              / count(DISTINCT order_id)::DOUBLE) * 100''')} AS return_rate
            FROM silver_order_items i JOIN silver_orders o USING (order_id) GROUP BY product_id) r USING (product_id)
      LEFT JOIN (SELECT i.product_id, {cents('sum(score)::DOUBLE / count(score)')} AS avg_review_score
            FROM silver_order_items i JOIN silver_reviews w USING (order_id)
            WHERE score IS NOT NULL GROUP BY i.product_id) v USING (product_id)""",
)

ACTIVITY = f"""activity AS (SELECT customer_id,
    date_sub('day', max(order_date), (SELECT max(order_date) FROM silver_orders))::BIGINT AS recency_days,
    count(DISTINCT order_id)::BIGINT AS frequency, {cents(money())} AS monetary
  FROM (SELECT customer_id, order_id, order_date, quantity, unit_price FROM {SALES} AND order_date IS NOT NULL)
  GROUP BY customer_id)"""


def quantile(values: str, p: float) -> str:
    """Linear interpolation between the neighbours in a sorted list of doubles."""
    position = f"((len({values}) - 1) * {p}::DOUBLE)"
    at = f"floor({position})::BIGINT"
    low, high = f"{values}[{at} + 1]", f"coalesce({values}[{at} + 2], {values}[{at} + 1])"
    return f"{low} + ({high} - {low}) * ({position} - {at})"


def _edges(name: str) -> str:
    points = ", ".join(quantile(f"l_{name}", p) for p in (0.25, 0.5, 0.75))
    return f"[{points}] AS {name}"


EDGES = f"""edges AS (SELECT {_edges('r')}, {_edges('f')}, {_edges('m')} FROM (
    SELECT list(recency_days::DOUBLE ORDER BY recency_days) AS l_r, list(frequency::DOUBLE ORDER BY frequency) AS l_f,
      list(monetary ORDER BY monetary) AS l_m FROM activity))"""


def above(value: str, edges: str) -> str:
    return "(" + " + ".join(f"({value} > {edges}[{i}])::INTEGER" for i in (1, 2, 3)) + ")"


def _with_activity(query: str) -> str:
    return with_tables(["order_items"], "").rstrip() + f", {ACTIVITY}, {EDGES} {query}"


RFM_CUT_POINTS = _with_activity(
    """SELECT 'recency_days' AS metric, r[1] AS q1, r[2] AS q2, r[3] AS q3 FROM edges
    UNION ALL SELECT 'frequency', f[1], f[2], f[3] FROM edges
    UNION ALL SELECT 'monetary', m[1], m[2], m[3] FROM edges"""
)

CUSTOMER_SEGMENTS = _with_activity(
    f"""SELECT customer_id, customer_name, state, recency_days, frequency, monetary, "R", "F", "M", rfm_score,
      CASE WHEN rfm_score >= 10 THEN 'Champions' WHEN rfm_score >= 8 THEN 'Loyal' WHEN rfm_score >= 6 THEN 'Potential'
        WHEN rfm_score >= 4 THEN 'At Risk' ELSE 'Lost' END AS segment
      FROM (SELECT *, ("R" + "F" + "M")::TINYINT AS rfm_score FROM (
        SELECT a.*, (4 - {above('recency_days', 'r')})::TINYINT AS "R", (1 + {above('frequency', 'f')})::TINYINT AS "F",
          (1 + {above('monetary', 'm')})::TINYINT AS "M" FROM activity a, edges))
      JOIN silver_customers USING (customer_id)"""
)

MONTH = "date_trunc('month', order_date)::TIMESTAMP AS month"
MONTHLY_KPIS = with_tables(
    ["order_items", "reviews"],
    f"""SELECT t.month, total_orders, num_canceled, revenue, num_orders, avg_review_score,
        {cents('(num_canceled::DOUBLE / total_orders::DOUBLE) * 100')} AS cancellation_rate
      FROM (SELECT {MONTH}, count(DISTINCT order_id)::BIGINT AS total_orders,
              (count(*) FILTER (WHERE status = 'canceled'))::BIGINT AS num_canceled
            FROM silver_orders WHERE order_date IS NOT NULL GROUP BY 1) t
      LEFT JOIN (SELECT {MONTH}, {cents(money())} AS revenue, count(DISTINCT order_id)::BIGINT AS num_orders
            FROM {SALES} AND order_date IS NOT NULL GROUP BY 1) s USING (month)
      LEFT JOIN (SELECT {MONTH}, {cents('sum(score)::DOUBLE / count(score)')} AS avg_review_score
            FROM silver_reviews JOIN silver_orders USING (order_id)
            WHERE order_date IS NOT NULL AND score IS NOT NULL GROUP BY 1) v USING (month)""",
)


def layer_counts() -> str:
    parts = []
    for name in KEYS:
        parts.append(f"SELECT 'bronze' AS layer, '{name}' AS \"table\", count(*)::BIGINT AS rows FROM raw_{name}")
        parts.append(f"SELECT 'silver', '{name}', count(*)::BIGINT FROM silver_{name}")
        parts.append(f"SELECT 'quarantine', '{name}', count(*)::BIGINT FROM ({quarantine_select(name)})")
    parts += gold_counts()
    return with_tables(list(KEYS), " UNION ALL ".join(parts))


def gold_counts() -> list[str]:
    """Rows of each Gold table, from the groups alone."""
    dated = f"{SALES} AND order_date IS NOT NULL"
    return [
        f"""SELECT 'gold', 'sales_by_state', count(DISTINCT coalesce(c.state, 'UNKNOWN'))::BIGINT
          FROM (SELECT customer_id FROM {SALES}) JOIN silver_customers c USING (customer_id)""",
        f"SELECT 'gold', 'product_performance', count(DISTINCT product_id)::BIGINT FROM {SALES}",
        f"SELECT 'gold', 'customer_segments', count(DISTINCT customer_id)::BIGINT FROM {dated}",
        """SELECT 'gold', 'monthly_kpis', count(DISTINCT date_trunc('month', order_date))::BIGINT
          FROM silver_orders WHERE order_date IS NOT NULL""",
    ]


def published() -> str:
    parts = []
    for name in KEYS:
        parts.append(f"SELECT 'silver' AS layer, '{name}' AS \"table\", count(*)::BIGINT AS rows FROM silver_{name}")
        parts.append(f"SELECT 'quarantine', '{name}', count(*)::BIGINT FROM ({quarantine_select(name)})")
    parts += gold_counts()
    every_check = " UNION ALL ".join(quality_select(name) for name in KEYS)
    parts.append(f"SELECT 'quality', 'checks', count(*)::BIGINT FROM ({every_check})")
    return with_tables(list(KEYS), " UNION ALL ".join(parts))
