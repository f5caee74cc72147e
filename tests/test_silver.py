from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import Tables
from sluice.config import INGESTED_AT, ROW_ORDER, SOURCE_FILE, TABLES
from sluice.plans import silver as s
from sluice.plans.specs import SPECS
from tests.helpers import texts, values

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 5, 6)
SILVER_ROWS = {
    "customers": 148,
    "products": 197,
    "orders": 1466,
    "order_items": 3931,
    "payments": 1433,
    "reviews": 1447,
}


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


def bronze(spark, names, rows):
    """Bronze rows from text tuples; their position is their order."""
    schema = ", ".join(f"{n} string" for n in names) + f", {ROW_ORDER} bigint"
    df = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], schema)
    return df.withColumn(SOURCE_FILE, F.lit("x.csv")).withColumn(
        INGESTED_AT, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    )


@pytest.mark.parametrize("name", TABLES)
def test_every_row_ends_up_once(tables, name):
    classified = tables.classified(name)
    spec = SPECS[name]
    kept = classified.silver()
    assert kept.count() == SILVER_ROWS[name]
    assert kept.select(spec.key).distinct().count() == SILVER_ROWS[name]
    reasons = {r["reject_reason"]: r["count"] for r in classified.quarantine().groupBy("reject_reason").count().collect()}
    audited = {column.reject_reason for column in spec.columns if column.accepted}
    removed = sum(n for reason, n in reasons.items() if reason not in audited)
    assert tables.raw(name).count() == SILVER_ROWS[name] + removed
    assert [(f.name, f.dataType) for f in kept.schema] == [
        (f.name, f.dataType) for f in spec.contract.schema
    ]


def test_results_hold_when_joins_are_shuffled(spark, shuffled_joins):
    tables = Tables(spark, SF)
    assert tables.classified("order_items").silver().count() == SILVER_ROWS["order_items"]


def test_first_broken_rule_wins_and_audit_copies_stay(spark, staging):
    names = ["payment_id", "order_id", "payment_type", "installments", "amount"]
    rows = [
        ("Y1", "O1", " PIX ", "1", "10.0"),
        ("Y2", "O9", "bitcoin", "x", "-1"),  # negative, orphan, unknown type: amount comes first
        ("Y1", "O1", "cash", "2", "11.0"),  # duplicate with an unknown type
        (None, "O9", "boleto", "1", "5"),  # orphan before missing key
        ("Y3", None, "voucher", None, "6"),  # a missing foreign key is kept
    ]
    classified = s.clean_payments(bronze(spark, names, rows), texts(spark, "order_id", ["O1"]), staging)
    assert sorted((r.payment_id, r.payment_type) for r in classified.silver().collect()) == [
        ("Y1", "pix"),
        ("Y3", "voucher"),
    ]
    quarantined = {(r.payment_id, r.payment_type, r.reject_reason) for r in classified.quarantine().collect()}
    assert quarantined == {
        ("Y2", "bitcoin", "invalid_payment_type"),
        ("Y2", None, "invalid_amount"),
        ("Y1", "cash", "invalid_payment_type"),
        ("Y1", None, "duplicate_payment_id"),
        (None, "boleto", "orphan_order"),
    }


def test_rejected_rows_do_not_compete_for_the_key(spark, staging):
    names = ["item_id", "order_id", "product_id", "quantity", "unit_price", "freight_value"]
    rows = [
        ("I1", "O1", "P1", "0", "1.0", "1"),
        ("I1", "O1", "P1", "2", "1.0", "1"),
        ("I1", "O1", "P1", "3", "1.0", "1"),
    ]
    orders, products = texts(spark, "order_id", ["O1"]), texts(spark, "product_id", ["P1"])
    classified = s.clean_order_items(bronze(spark, names, rows), orders, products, staging)
    assert values(classified.silver(), "quantity") == [2]
    assert sorted((r.quantity, r.reject_reason) for r in classified.quarantine().collect()) == [
        (0, "invalid_quantity"),
        (3, "duplicate_item_id"),
    ]


def test_latest_with_ties_and_missing_dates(spark, staging):
    names = ["review_id", "order_id", "score", "title", "comment", "created_at"]
    rows = [
        ("R1", "O1", "1", "undated", "", "never"),
        ("R1", "O1", "2", "first of the latest", "", "2024-01-02 00:00:00"),
        ("R1", "O1", "3", "tie", "", "2024-01-02 00:00:00"),
        ("R1", "O1", "4", "older", "", "2024-01-01 00:00:00"),
        ("R2", "O1", "9", "undated but alone", "", None),
    ]
    classified = s.clean_reviews(bronze(spark, names, rows), texts(spark, "order_id", ["O1"]), staging)
    kept = {r.title: r.score for r in classified.silver().collect()}
    assert kept == {"first of the latest": 2, "undated but alone": None}


def test_unknown_columns_are_passed_on_to_the_contract(spark, staging):
    names = ["product_id", "product_name", "category", "price", "weight_kg", "color"]
    classified = s.clean_products(bronze(spark, names, [("P1", "a", "toys", "1", "2", "red")]), staging)
    assert "color" in classified.silver().columns


def test_orders_and_customers(spark, staging):
    names = ["customer_id", "customer_name", "email", "city", "state", "created_at"]
    rows = [(" C1 ", " Ana ", " A@X.com", None, "sp", "2024-01-01 00:00:00"), ("  ", "b", None, None, None, None)]
    customers = s.clean_customers(bronze(spark, names, rows), staging)
    (row,) = customers.silver().collect()
    assert (row.customer_id, row.customer_name, row.email, row.state) == ("C1", "Ana", "a@x.com", "SP")
    names = ["order_id", "customer_id", "status", "order_date", "approved_at", "delivered_at"]
    rows = [("O1", "C1", "Lost", "2024-01-01 00:00:00", None, None), ("O2", "C2", "shipped", None, None, None)]
    orders = s.clean_orders(bronze(spark, names, rows), customers.silver().select("customer_id"), staging)
    assert [(r.order_id, r.status) for r in orders.silver().collect()] == [("O1", None)]
    assert sorted((r.status, r.reject_reason) for r in orders.quarantine().collect()) == [
        ("lost", "invalid_status"),
        ("shipped", "orphan_customer"),
    ]


def test_decided_rows_are_read_back(tables, capsys):
    """Silver, quarantine and quality neither parse nor shuffle the rows again."""
    for name in TABLES:
        classified = tables.classified(name)
        for df in (classified.silver(), classified.quarantine()):
            df.explain()
            plan = capsys.readouterr().out
            assert "Exchange" not in plan and plan.count("FileScan parquet") == 1
        counted = classified.quality(NOW).select("check_name", "column", "records_checked", "records_failed")
        expected = [(c.check_name, c.column, classified.counts["checked"], classified.counts[f"failed_{i}"])
                    for i, c in enumerate(classified.checks())]
        assert sorted(map(tuple, counted.collect())) == sorted(expected)


def test_uniqueness_is_looked_at_unless_it_is_proven(spark):
    spec = SPECS["customers"]
    schema = spec.contract.schema
    empty = spark.createDataFrame([], schema)
    twice = spark.createDataFrame([(1,), (2,)], "i int").select(
        *(F.lit("C1" if f.name == spec.key else None).cast(f.dataType).alias(f.name) for f in schema)
    )
    n_rules = len(spec.contract.row_rules(spec.contract.names))
    counts = {f"rule_{i}": 0 for i in range(n_rules)} | {"silver": 2}
    proven = s.Classified(spec, empty, [], unique_rows=2)
    s._gate(proven, counts, twice)  # not read again
    with pytest.raises(s.ContractError) as error:
        s._gate(s.Classified(spec, empty, [], unique_rows=1), counts, twice)
    assert error.value.violations == [(spec.key, "unique", 2)]
    with pytest.raises(s.ContractError):
        s._gate(proven, counts | {"rule_0": 3}, twice)


@pytest.mark.parametrize("name", ["customers", "order_items"])
def test_written_fates_are_silver_and_quarantine(tables, name):
    classified = tables.classified(name)
    fates = classified.fates()
    for kept, wanted in ((fates.where("reject_reason IS NULL").drop("reject_reason"), classified.silver()),
                         (fates.where("reject_reason IS NOT NULL"), classified.quarantine())):
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, wanted.collect()))


def test_first_rows_come_with_the_counts(spark, staging, shuffled_joins, monkeypatch):
    """Where the first row of a key stays, one aggregate finds it, and rejected rows stay where they are."""
    from sluice.plans import classify

    searches, search = [], classify.repeat_winners
    monkeypatch.setattr(classify, "repeat_winners", lambda *a: searches.append(1) or search(*a))
    names = ["item_id", "order_id", "product_id", "quantity", "unit_price", "freight_value"]
    rows = [(f"I{i % 40}", f"O{i % 5}", "P1", "0" if i % 7 == 0 else "2", "1.5", "0.5") for i in range(200)]
    parents = {"orders": texts(spark, "order_id", [f"O{i}" for i in range(4)]), "products": texts(spark, "product_id", ["P1"])}
    judged = classify.apply_rules(bronze(spark, names, rows), SPECS["order_items"], parents, staging)
    decided = classify.decide(judged, staging)
    assert not searches and "Union" in decided.rows._jdf.queryExecution().toString()

    kept, seen = [], set()
    for i, (item, order, _, quantity, *_) in enumerate(rows):
        if order != "O4" and quantity != "0" and item not in seen:
            seen.add(item)
            kept.append(i)
    assert sorted(values(decided.rows.where(f"{classify.REASON} IS NULL"), ROW_ORDER)) == kept
    assert decided.unique_rows == len(kept) and decided.rows.count() == len(rows)
    assert decided.rows.where(f"{classify.REASON} = 'duplicate_item_id'").count() == sum(
        order != "O4" and quantity != "0" for _, order, _, quantity, *_ in rows
    ) - len(kept)
