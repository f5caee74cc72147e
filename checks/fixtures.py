"""The six raw tables, derived from the test tables with faults worked in.

The same SQL text runs on Spark and on the checking engine. Faults come from key
arithmetic, so they are the same everywhere and grow with the data. `_ord` stands for
the position of the row in its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import INGESTED_AT, SOURCE_FILE

SOURCES = ("customer", "part", "orders", "lineitem")

RAW_CUSTOMERS = """
SELECT CAST(c_custkey AS BIGINT) AS _ord,
  CASE WHEN c_custkey % 97 = 13 THEN NULL ELSE concat(' C', CAST(c_custkey AS STRING), ' ') END AS customer_id,
  CASE WHEN c_custkey % 31 = 0 THEN '   ' ELSE c_name END AS customer_name,
  CASE WHEN c_custkey % 23 = 5 THEN NULL ELSE concat('User', CAST(c_custkey AS STRING), '@Mail.COM') END AS email,
  concat('City ', CAST(c_nationkey AS STRING)) AS city,
  CASE WHEN c_custkey % 29 = 3 THEN NULL ELSE concat('s', CAST(c_nationkey AS STRING)) END AS state,
  concat('2022-05-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0'), ' 01:01:00') AS created_at
FROM {customer}
UNION ALL
SELECT 1000000 + c_custkey, concat('C', CAST(c_custkey AS STRING)), concat(c_name, ' v2'), NULL, 'City X', 'zz', '2023-01-01 00:00:00'
FROM {customer} WHERE c_custkey % 50 = 7
"""

RAW_PRODUCTS = """
SELECT CAST(p_partkey AS BIGINT) AS _ord,
  CASE WHEN p_partkey % 83 = 11 THEN NULL ELSE concat('P', CAST(p_partkey AS STRING)) END AS product_id,
  p_name AS product_name,
  CASE WHEN p_partkey % 37 = 1 THEN NULL WHEN p_partkey % 43 = 0 THEN 'sportss'
    WHEN p_type = 'ECONOMY' THEN 'sports' WHEN p_type = 'LARGE' THEN 'Toys ' WHEN p_type = 'MEDIUM' THEN 'books'
    WHEN p_type = 'PROMO' THEN ' ELECTRONICS' WHEN p_type = 'SMALL' THEN 'pet_shop' ELSE 'beauty' END AS category,
  CASE WHEN p_partkey % 47 = 3 THEN 'N/A' WHEN p_partkey % 53 = 2 THEN concat('-', CAST(p_retailprice AS STRING)) ELSE CAST(p_retailprice AS STRING) END AS price,
  CASE WHEN p_partkey % 59 = 5 THEN 'heavy' ELSE CAST(p_size AS STRING) END AS weight_kg
FROM {part}
UNION ALL
SELECT 1000000 + p_partkey, concat('P', CAST(p_partkey AS STRING)), 'copy', 'music', '99.0', '1'
FROM {part} WHERE p_partkey % 50 = 9
"""

RAW_ORDERS = """
SELECT CAST(o_orderkey AS BIGINT) AS _ord,
  CASE WHEN o_orderkey % 199 = 6 THEN NULL ELSE concat('O', CAST(o_orderkey AS STRING)) END AS order_id,
  CASE WHEN o_orderkey % 211 = 4 THEN 'C_MISSING' ELSE concat('C', CAST(o_custkey AS STRING)) END AS customer_id,
  CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' WHEN o_orderkey % 13 = 0 THEN ' Canceled' WHEN o_orderkey % 17 = 0 THEN 'returned'
    WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'shipped ' ELSE 'processing' END AS status,
  CASE WHEN o_orderkey % 101 = 9 THEN 'not-a-date' ELSE concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 0', CAST(o_orderkey % 10 AS STRING), ':30:00') END AS order_date,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 12:00:00') END AS approved_at,
  CASE WHEN o_orderstatus = 'F' THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 23:59:59') ELSE NULL END AS delivered_at
FROM {orders}
UNION ALL
SELECT 1000000 + o_orderkey, concat('O', CAST(o_orderkey AS STRING)), concat('C', CAST(o_custkey AS STRING)), 'shipped', '2001-08-02 10:00:00', NULL, NULL
FROM {orders} WHERE o_orderkey % 60 = 3
"""

RAW_ORDER_ITEMS = """
SELECT l_orderkey * 100000000000 + l_linenumber * 10000000000 + l_partkey * 100000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT) AS _ord,
  CASE WHEN l_partkey % 307 = 8 THEN NULL ELSE concat('I', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS item_id,
  CASE WHEN l_suppkey % 97 = 1 THEN 'O_MISSING' ELSE concat('O', CAST(l_orderkey AS STRING)) END AS order_id,
  concat('P', CAST(l_partkey AS STRING)) AS product_id,
  CASE WHEN l_orderkey % 59 = 1 THEN '0' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS quantity,
  CASE WHEN l_orderkey % 61 = 2 THEN 'abc' ELSE CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS DOUBLE) / CAST(100 AS DOUBLE) AS STRING) END AS unit_price,
  CASE WHEN l_orderkey % 67 = 3 THEN 'free' ELSE CAST(l_tax AS STRING) END AS freight_value
FROM {lineitem}
"""

RAW_PAYMENTS = """
SELECT CAST(o_orderkey AS BIGINT) AS _ord,
  CASE WHEN o_orderkey % 181 = 5 THEN NULL ELSE concat('Y', CAST(o_orderkey AS STRING)) END AS payment_id,
  CASE WHEN o_orderkey % 149 = 7 THEN 'O_MISSING' ELSE concat('O', CAST(o_orderkey AS STRING)) END AS order_id,
  CASE WHEN o_orderkey % 71 = 1 THEN 'bitcoin' WHEN o_orderkey % 5 = 0 THEN 'Credit_Card' WHEN o_orderkey % 5 = 1 THEN ' boleto'
    WHEN o_orderkey % 5 = 2 THEN 'voucher' WHEN o_orderkey % 5 = 3 THEN 'debit_card' ELSE 'PIX' END AS payment_type,
  CASE WHEN o_orderkey % 89 = 1 THEN 'x' ELSE CAST(1 + o_orderkey % 12 AS STRING) END AS installments,
  CASE WHEN o_orderkey % 103 = 2 THEN '-5.0' ELSE CAST(o_totalprice AS STRING) END AS amount
FROM {orders}
UNION ALL
SELECT 1000000 + o_orderkey, concat('Y', CAST(o_orderkey AS STRING)), concat('O', CAST(o_orderkey AS STRING)), 'pix', '1', '1.0'
FROM {orders} WHERE o_orderkey % 90 = 11
"""

RAW_REVIEWS = """
SELECT CAST(o_orderkey AS BIGINT) AS _ord,
  CASE WHEN o_orderkey % 177 = 9 THEN NULL ELSE concat('R', CAST(o_orderkey AS STRING)) END AS review_id,
  CASE WHEN o_orderkey % 151 = 3 THEN 'O_MISSING' ELSE concat('O', CAST(o_orderkey AS STRING)) END AS order_id,
  CASE WHEN o_orderkey % 69 = 0 THEN 'five' ELSE CAST(o_orderkey % 7 AS STRING) END AS score,
  CASE WHEN o_orderkey % 4 = 0 THEN '  ' ELSE ' ok' END AS title,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS comment,
  concat('2024-02-', lpad(CAST(1 + o_orderkey % 28 AS STRING), 2, '0'), ' 08:00:00') AS created_at
FROM {orders}
UNION ALL
SELECT 1000000 + o_orderkey, concat('R', CAST(o_orderkey AS STRING)), concat('O', CAST(o_orderkey AS STRING)), '5', 'newer', NULL, '2024-03-01 00:00:00'
FROM {orders} WHERE o_orderkey % 120 = 21
"""

RAW_SQL = {
    "customers": RAW_CUSTOMERS,
    "products": RAW_PRODUCTS,
    "orders": RAW_ORDERS,
    "order_items": RAW_ORDER_ITEMS,
    "payments": RAW_PAYMENTS,
    "reviews": RAW_REVIEWS,
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived raw table: `_ord` and the text columns."""
    text = RAW_SQL[name]
    tables = {s: source(spark, sf_dir, s) for s in SOURCES if f"{{{s}}}" in text}
    return spark.sql(text, **tables)


def bronze_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw table with the lineage columns Bronze adds."""
    return raw_table(spark, sf_dir, name).select(
        "*",
        F.lit(f"{name}.csv").alias(SOURCE_FILE),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias(INGESTED_AT),
    )


def raw_sql(name: str) -> str:
    """The raw table's SQL over tables registered under their own names."""
    return RAW_SQL[name].format(**{s: s for s in SOURCES})
