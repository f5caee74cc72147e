import csv
import os
from datetime import datetime

import pytest

from checks.queries import Tables, write_raw_csv
from sluice.config import GOLD_TABLES, QUALITY, QUARANTINE, ROW_ORDER, SILVER, TABLES, raw_path
from sluice.operators.contracts import ContractError
from sluice.plans import build
from sluice.plans.bronze import build_bronze, ingest
from sluice.plans.build import run
from sluice.plans.silver import build_silver
from sluice.sources.store import exists, list_names, load_gold, load_quality, read_table
from sluice.sources.versions import current, finish
from sluice.sources.warehouse import attach, unpublish
from tests.test_silver import SILVER_ROWS

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 5, 6, 7, 8, 9)

RAW = {
    "customers": [
        ["customer_id", "customer_name", "email", "city", "state", "created_at"],
        ["C1", "Ana", "a@x.com", "Rio", "rj", "2024-01-01 00:00:00"],
    ],
    "products": [
        ["product_id", "product_name", "category", "price", "weight_kg"],
        ["P1", "ball", "toys", "9.9", "1"],
    ],
    "orders": [
        ["order_id", "customer_id", "status", "order_date", "approved_at", "delivered_at"],
        ["O1", "C1", "shipped", "2024-01-02 00:00:00", "", ""],
    ],
    "order_items": [
        ["item_id", "order_id", "product_id", "quantity", "unit_price", "freight_value"],
        ["I1", "O1", "P1", "2", "9.9", "1"],
    ],
    "payments": [
        ["payment_id", "order_id", "payment_type", "installments", "amount"],
        ["Y1", "O1", "pix", "1", "19.8"],
    ],
    "reviews": [
        ["review_id", "order_id", "score", "title", "comment", "created_at"],
        ["R1", "O1", "5", "good", 'two\nlines, "quoted"', "2024-01-03 00:00:00"],
    ],
}


def land(root, name, rows):
    os.makedirs(f"{root}/raw", exist_ok=True)
    with open(raw_path(root, name), "w", newline="") as file:
        csv.writer(file).writerows(rows)


@pytest.fixture
def small_root(tmp_path):
    for name, rows in RAW.items():
        land(str(tmp_path), name, rows)
    return str(tmp_path)


def build_upto(spark, root, last, staging):
    for name in TABLES[: TABLES.index(last) + 1]:
        build_bronze(spark, root, name, NOW)
        build_silver(spark, root, name, staging, NOW)


def snapshot(spark, root):
    tables = {f"gold {n}": df for n, df in load_gold(spark, root).items()}
    for layer in (SILVER, QUARANTINE, QUALITY):
        tables |= {f"{layer} {n}": read_table(spark, root, layer, n) for n in TABLES}
    return {name: sorted(map(repr, df.collect())) for name, df in tables.items()}


def test_whole_build_is_complete_and_repeatable(spark, tmp_path):
    root = str(tmp_path)
    tables = Tables(spark, SF)
    for name in TABLES:
        write_raw_csv(tables, root, name)
    try:
        run(spark, root, NOW, "built_")
        built = current(spark, root)
        assert {n: read_table(spark, built, SILVER, n).count() for n in TABLES} == SILVER_ROWS
        assert load_quality(spark, built).count() == 59
        first = snapshot(spark, built)
        assert len(first) == 18 + len(GOLD_TABLES)

        spark.sql("CREATE TABLE built_gold.stale USING parquet AS SELECT 1 AS x")
        run(spark, root, NOW, "built_")
        assert current(spark, root) != built and snapshot(spark, current(spark, root)) == first
        assert not exists(spark, f"{root}/_staging") or not list_names(spark, f"{root}/_staging")
        assert not spark.catalog.tableExists("built_gold.stale")

        unpublish(spark, "built_")
        assert len(attach(spark.newSession(), root, "built_")) == 17
        assert spark.sql("SELECT count(*) FROM built_silver.orders").first()[0] == SILVER_ROWS["orders"]
        assert spark.sql("SELECT count(*) FROM built_quality.checks").first()[0] == 59
        assert spark.sql("SELECT sum(num_orders) FROM built_gold.sales_by_state").first()[0] > 0
    finally:
        unpublish(spark, "built_")


def shuffle_files(spark):
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    found = (f"{d}/{name}" for folder in folders for d, _, names in os.walk(folder.getPath()) for name in names)
    return {path for path in found if os.path.basename(path).startswith("shuffle_")}


def test_a_build_leaves_no_shuffles(spark, small_root, monkeypatch):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, value, left = shuffle_files(spark), spark.conf.get(setting, None), []

    def finished(*about):
        left.extend(shuffle_files(spark) - before)
        return finish(*about)

    monkeypatch.setattr(build, "finish", finished)
    try:
        run(spark, small_root, NOW, "tidy_")
    finally:
        unpublish(spark, "tidy_")
    assert not left and spark.conf.get(setting, None) == value


def test_a_silver_table_leaves_nothing_staged(spark, small_root, staging):
    build_upto(spark, small_root, "orders", staging)
    assert list_names(spark, staging.path) == []


def test_raw_files_arrive_compressed(spark, tmp_path):
    write_raw_csv(Tables(spark, SF), str(tmp_path), "customers")
    names = [n for n in list_names(spark, raw_path(str(tmp_path), "customers")) if n.startswith("part-")]
    assert names and all(n.endswith(".csv.gz") for n in names)


def test_a_failing_build_leaves_the_version_before(spark, small_root):
    """Readers go on with all tables of one run when the next one stops on the way."""
    try:
        run(spark, small_root, NOW, "kept_")
        built = current(spark, small_root)
        first = snapshot(spark, built)
        header, row = RAW["payments"]
        land(small_root, "customers", [RAW["customers"][0], [*RAW["customers"][1][:4], "sp", *RAW["customers"][1][5:]]])
        land(small_root, "payments", [header, [*row[:4], "x"]])  # its contract fails after others were built
        with pytest.raises(ContractError):
            run(spark, small_root, NOW, "kept_")
        assert current(spark, small_root) == built and snapshot(spark, built) == first
        assert spark.sql("SELECT state FROM kept_silver.customers").first()[0] == "RJ"
        land(small_root, "payments", RAW["payments"])
        run(spark, small_root, NOW, "kept_")
        assert spark.sql("SELECT state FROM kept_silver.customers").first()[0] == "SP"
        assert len(list_names(spark, f"{small_root}/runs")) == 2
    finally:
        unpublish(spark, "kept_")


def test_line_breaks_in_any_table(spark, tmp_path):
    rows = [["a", "b"], ["1", "two\nlines"]]
    land(str(tmp_path), "anything", rows)
    (row,) = ingest(spark, str(tmp_path), "anything", NOW, multi_line=True).collect()
    assert (row.a, row.b) == ("1", "two\nlines")


def test_quoted_line_breaks_and_empty_fields(spark, small_root):
    (review,) = ingest(spark, small_root, "reviews", NOW).collect()
    assert review.comment == 'two\nlines, "quoted"'
    (order,) = ingest(spark, small_root, "orders", NOW).collect()
    assert order.approved_at is None
    assert (order._source_file, order._ingested_at) == ("orders.csv", NOW)


def test_bronze_keeps_text_as_it_is(spark, tmp_path):
    land(str(tmp_path), "anything", [["a", "b"], [" 007 ", "NULL"], ["", '""']])
    df = ingest(spark, str(tmp_path), "anything", NOW)
    assert [tuple(r[:2]) for r in df.collect()] == [(" 007 ", "NULL"), (None, '""')]
    assert {t for n, t in df.dtypes if n in "ab"} == {"string"}


def test_ragged_rows_are_an_error(spark, tmp_path):
    land(str(tmp_path), "anything", [["a", "b"], ["1", "2", "3"]])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        ingest(spark, str(tmp_path), "anything", NOW).collect()


def test_first_row_follows_file_order(spark, tmp_path, staging):
    """Files of very different sizes are read out of order; `_ord` still follows them."""
    root = str(tmp_path)
    folder = raw_path(root, "products")
    os.makedirs(folder)
    header = RAW["products"][0]
    for file, n in (("part-0.csv", 3), ("part-1.csv", 20000), ("part-2.csv", 50)):
        with open(f"{folder}/{file}", "w", newline="") as out:
            rows = [[f"P{i % 5}", f"{file}:{i}", "toys", "1", "1"] for i in range(n)]
            csv.writer(out).writerows([header, *rows])
    build_bronze(spark, root, "products", NOW)
    kept = build_silver(spark, root, "products", staging, NOW)
    names = {r.product_id: r.product_name for r in kept.collect()}
    assert names == {
        "P0": "part-0.csv:0",
        "P1": "part-0.csv:1",
        "P2": "part-0.csv:2",
        "P3": "part-1.csv:3",
        "P4": "part-1.csv:4",
    }
    assert ROW_ORDER not in kept.columns


RED = [
    ("customers", 5, "never", "created_at", "not_null"),
    ("products", 4, "-1", "weight_kg", "ge(0)"),
    ("orders", 1, "", "customer_id", "not_null"),
    ("order_items", 3, "x", "quantity", "not_null"),
    ("order_items", 5, "-1", "freight_value", "ge(0)"),
    ("payments", 4, "x", "amount", "not_null"),
]


@pytest.mark.parametrize("name, position, fault, column, rule", RED)
def test_contract_stops_the_table(spark, small_root, staging, name, position, fault, column, rule):
    header, row = RAW[name]
    second = ["Z9", *row[1:]]
    second[position] = fault
    build_upto(spark, small_root, name, staging)
    before = snapshot_table(spark, small_root, name)
    land(small_root, name, [header, row, second])
    build_bronze(spark, small_root, name, NOW)
    with pytest.raises(ContractError) as error:
        build_silver(spark, small_root, name, staging, NOW)
    assert (column, rule, 1) in error.value.violations
    assert snapshot_table(spark, small_root, name) == before


def snapshot_table(spark, root, name):
    return {layer: sorted(map(repr, read_table(spark, root, layer, name).collect()))
            for layer in (SILVER, QUARANTINE, QUALITY)}


def test_an_extra_column_stops_the_table(spark, small_root, staging):
    header, row = RAW["products"]
    land(small_root, "products", [[*header, "color"], [*row, "red"]])
    build_bronze(spark, small_root, "products", NOW)
    with pytest.raises(ContractError) as error:
        build_silver(spark, small_root, "products", staging, NOW)
    assert ("color", "column_in_schema", 0) in error.value.violations
    assert not exists(spark, f"{small_root}/silver/products")


def test_a_table_without_rejects_has_an_empty_quarantine(spark, small_root, staging):
    build_upto(spark, small_root, "customers", staging)
    quarantined = read_table(spark, small_root, QUARANTINE, "customers")
    assert quarantined.count() == 0
    assert quarantined.columns[-1] == "reject_reason"


@pytest.mark.parametrize("rows", [[], [["", "Bo", "b@x.com", "Rio", "rj", "2024-01-01 00:00:00"]]])
def test_a_table_of_which_nothing_is_left(spark, small_root, staging, rows):
    land(small_root, "customers", [RAW["customers"][0], *rows])
    build_upto(spark, small_root, "customers", staging)
    silver = read_table(spark, small_root, SILVER, "customers")
    assert silver.count() == 0 and "reject_reason" not in silver.columns
    assert read_table(spark, small_root, QUARANTINE, "customers").count() == len(rows)
    quality = read_table(spark, small_root, QUALITY, "customers")
    assert {r.records_checked for r in quality.collect()} == {len(rows)}
    assert not [n for n in list_names(spark, f"{small_root}/{SILVER}") if n.startswith("_")]


def test_line_breaks_in_any_table(spark, small_root, staging):
    header, row = RAW["customers"]
    land(small_root, "customers", [header, [row[0], "Ana\nMaria", *row[2:]]])
    build_bronze(spark, small_root, "customers", NOW, multi_line=True)
    silver = build_silver(spark, small_root, "customers", staging, NOW)
    assert [r.customer_name for r in silver.collect()] == ["Ana\nMaria"]


def test_large_files_that_cannot_be_split_are_named(spark, small_root, monkeypatch):
    monkeypatch.setattr("sluice.plans.bronze.LARGEST_UNSPLIT", 10)
    with pytest.warns(UserWarning, match="reviews.csv"):
        ingest(spark, small_root, "reviews", NOW)


def test_a_broken_swap_leaves_one_whole_table(spark, small_root, monkeypatch):
    """Stopped after the old table stepped aside: readers still find it, the next write repairs it."""
    from sluice.sources import store

    build_bronze(spark, small_root, "customers", NOW)
    before = sorted(map(repr, read_table(spark, small_root, "bronze", "customers").drop(ROW_ORDER).collect()))
    rename, calls = store._rename, []

    def stops(spark, source, target):
        calls.append(source)
        if len(calls) == 2:
            raise OSError("stopped")
        rename(spark, source, target)

    monkeypatch.setattr(store, "_rename", stops)
    with pytest.raises(OSError, match="stopped"):
        build_bronze(spark, small_root, "customers", NOW)
    monkeypatch.undo()
    again = lambda: sorted(map(repr, read_table(spark, small_root, "bronze", "customers").drop(ROW_ORDER).collect()))
    assert again() == before
    build_bronze(spark, small_root, "customers", NOW)
    assert again() == before
    assert list_names(spark, f"{small_root}/bronze") == ["customers"]
