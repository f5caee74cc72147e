"""Every operator as a query over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.fixtures import bronze_table, raw_table, source
from sluice.config import BRONZE, INGESTED_AT, QUARANTINE, ROW_ORDER, SILVER, TABLES, raw_path, table_path
from sluice.operators import columns, profile, splits
from sluice.operators.contracts import VIOLATIONS_SCHEMA, ContractError, contract_violations, validate
from sluice.operators.quality import Findings, missing, unaccepted
from sluice.plans import gold
from sluice.plans.bronze import ingest
from sluice.plans.build import run
from sluice.plans.classify import Classified, Judged, apply_rules, decide, drop_repeats, normalize
from sluice.plans.silver import build_silver
from sluice.plans.specs import ORDER_ITEMS, ORDERS, PRODUCT_CATEGORIES, SPECS
from sluice.sources.staging import Staging
from sluice.sources.store import count_rows, load_gold, read_parquet, read_table, write_parquet
from sluice.sources.versions import current
from sluice.sources.warehouse import attach, unpublish

Query = Callable[[SparkSession, str], DataFrame]
NOW = datetime(2024, 1, 1)


class Tables:
    """The derived tables of one scale factor, each built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._judged: dict[str, Judged] = {}
        self._classified: dict[str, Classified] = {}
        self._decided: dict[str, Classified] = {}

    @cached_property
    def staging(self) -> Staging:
        return Staging(self.spark)

    def raw(self, name: str) -> DataFrame:
        return raw_table(self.spark, self.sf_dir, name)

    def bronze(self, name: str) -> DataFrame:
        return bronze_table(self.spark, self.sf_dir, name)

    def judged(self, name: str) -> Judged:
        if name not in self._judged:
            spec = SPECS[name]
            parents = {p: self.judged(p).keys() for p in spec.parents}
            self._judged[name] = apply_rules(self.bronze(name), spec, parents, self.staging)
        return self._judged[name]

    def classified(self, name: str) -> Classified:
        if name not in self._classified:
            self._classified[name] = drop_repeats(self.judged(name), self.staging)
        return self._classified[name]

    def silver(self, name: str) -> DataFrame:
        return self.classified(name).silver()

    def silver_once(self, name: str) -> DataFrame:
        """Silver for a query that reads it once: not stored, so only columns in use are shuffled."""
        if name not in self._decided:
            self._decided[name] = decide(self.judged(name), self.staging, rejected=False)
        return self._decided[name].silver()


def _query(body: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: body(Tables(spark, sf_dir))


# -- cleaning operators ---------------------------------------------------------------


def strip_strings(t: Tables) -> DataFrame:
    names = ["customer_id", "customer_name", "email", "city", "state"]
    return columns.strip_strings(t.raw("customers"), names).select(ROW_ORDER, *names)


def lowercase(t: Tables) -> DataFrame:
    return columns.lowercase(t.raw("customers"), "email").select(ROW_ORDER, "email")


def uppercase(t: Tables) -> DataFrame:
    return columns.uppercase(t.raw("customers"), "state").select(ROW_ORDER, "state")


def parse_datetime(t: Tables) -> DataFrame:
    df = t.raw("orders")
    for name in ("order_date", "approved_at", "delivered_at"):
        df = columns.parse_datetime(df, name)
    return df.select(ROW_ORDER, "order_date", "approved_at", "delivered_at")


def parse_datetime_pattern(t: Tables) -> DataFrame:
    """Another pattern, under a session zone whose clocks skip hours and under UTC."""
    key = "spark.sql.session.timeZone"
    before = t.spark.conf.get(key)
    day = F.concat_ws("/", F.substring("order_date", 9, 2), F.substring("order_date", 6, 2), F.substring("order_date", 1, 4))
    frames = []
    for zone in ("America/Sao_Paulo", "UTC"):
        t.spark.conf.set(key, zone)
        df = columns.parse_datetime(t.raw("orders").select(ROW_ORDER, day.alias("day")), "day", "dd/MM/yyyy")
        frames.append(df.select(F.lit(zone).alias("zone"), ROW_ORDER, "day"))
        frames[-1].schema  # analysed under this zone
    t.spark.conf.set(key, before)
    return frames[0].unionAll(frames[1])


def cast_float(t: Tables) -> DataFrame:
    df, failed = columns.cast_float(t.raw("products"), "price")
    return df.select(ROW_ORDER, "price", F.lit(failed).cast("bigint").alias("n_failed"))


def cast_int(t: Tables) -> DataFrame:
    df, failed = columns.cast_int(t.raw("payments"), "installments")
    return df.select(ROW_ORDER, "installments", F.lit(failed).cast("bigint").alias("n_failed"))


def nullify_outside_range(t: Tables) -> DataFrame:
    df, _ = columns.cast_int(t.raw("reviews"), "score")
    df, nulled = columns.nullify_outside_range(df, "score", low=1, high=5)
    return df.select(ROW_ORDER, "score", F.lit(nulled).cast("bigint").alias("n_nulled"))


def _range_split(t: Tables) -> splits.Split:
    df, _ = columns.cast_int(t.raw("order_items"), "quantity")
    return splits.split_outside_range(df.select(ROW_ORDER, "item_id", "quantity"), "quantity", low=1)


def _category_split(t: Tables) -> splits.Split:
    df = columns.strip_strings(t.raw("products"), ["product_id", "product_name", "category"])
    df = columns.lowercase(df, "category")
    return splits.nullify_not_in_set(df, "category", PRODUCT_CATEGORIES)


def _null_split(t: Tables) -> splits.Split:
    df = t.raw("customers").select(ROW_ORDER, "customer_id", "customer_name")
    return splits.drop_null_keys(df, "customer_id")


def _orphan_split(t: Tables) -> splits.Split:
    items = t.raw("order_items").select(ROW_ORDER, "item_id", "order_id")
    return splits.split_orphans(items, "order_id", t.raw("orders").select("order_id"), t.staging)


def _latest_split(t: Tables) -> splits.Split:
    df = columns.parse_datetime(t.raw("orders"), "order_date")
    df = df.select(ROW_ORDER, "order_id", "status", "order_date")
    return splits.deduplicate_by_key(df, "order_id", "order_date", staging=t.staging)


def _first_split(t: Tables) -> splits.Split:
    df = t.raw("order_items").select(ROW_ORDER, "item_id", "product_id")
    return splits.deduplicate_by_key(df, "item_id", staging=t.staging)


def quarantine_union(t: Tables) -> DataFrame:
    _, unknown = _category_split(t)
    _, missing = splits.drop_null_keys(t.raw("products"), "product_id")
    return splits.quarantine(
        (missing.select(ROW_ORDER, "product_name"), "null_product_id"),
        (unknown.select(ROW_ORDER, "product_id", "category"), "invalid_category"),
    )


# -- quality and contracts ------------------------------------------------------------


def null_counts(t: Tables) -> DataFrame:
    found = Findings(t.spark)
    for name in TABLES:
        df = t.raw(name)
        found.check(df, *(missing(name, c, "bronze") for c in df.columns if c != ROW_ORDER))
    return found.rows(NOW).drop("executed_at")


def duplicate_check(t: Tables) -> DataFrame:
    found = Findings(t.spark)
    for name in TABLES:
        found.check_repeats(t.raw(name), name, SPECS[name].key, "bronze")
    return found.rows(NOW).drop("executed_at")


def accepted_values_check(t: Tables) -> DataFrame:
    check = unaccepted("products", "category", PRODUCT_CATEGORIES, "bronze")
    return Findings(t.spark).check(t.raw("products"), check).rows(NOW).drop("executed_at")


def row_count_check(t: Tables) -> DataFrame:
    kept, _ = _null_split(t)
    before, after = t.raw("customers").count(), kept.count()
    return Findings(t.spark).note_shrinkage("customers", before, after, "silver").rows(NOW).drop("executed_at")


def quality_checks(t: Tables) -> DataFrame:
    frames = [t.classified(name).quality(NOW) for name in TABLES]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.drop("executed_at")


def _typed(t: Tables, name: str) -> DataFrame:
    """A table that was typed but not cleaned: it breaks most of its rules."""
    bronze = t.bronze(name)
    return normalize(bronze, SPECS[name]).select(*(c for c in bronze.columns if c != ROW_ORDER))


def _contract(frame: Callable[[Tables, str], DataFrame], name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: contract_violations(frame(t, name), SPECS[name].contract)


def contract_shape(t: Tables) -> DataFrame:
    """Raw orders: columns that lack, are too many, or are still text; statuses as they came."""
    return contract_violations(t.raw("orders"), ORDERS.contract)


def contract_raises(t: Tables) -> DataFrame:
    """Everything that the error of a failed validation names."""
    try:
        validate(_typed(t, "order_items"), ORDER_ITEMS.contract, "order_items")
    except ContractError as error:
        return t.spark.createDataFrame(error.violations, VIOLATIONS_SCHEMA)
    return t.spark.createDataFrame([], VIOLATIONS_SCHEMA)


def contract_gate(t: Tables) -> DataFrame:
    """A build whose contract fails leaves the files of the build before."""
    root = t.staging.new_path("root")
    for faulty in (False, True):
        bronze = t.bronze("customers")
        if faulty:
            bronze = bronze.withColumn("created_at", F.lit("some day"))
        write_parquet(bronze, table_path(root, BRONZE, "customers"))
        try:
            build_silver(t.spark, root, "customers", t.staging, NOW)
            raised = False
        except ContractError:
            raised = True
    rows = count_rows({"customers": read_table(t.spark, root, SILVER, "customers")})
    return rows.withColumn("raised", F.lit(raised))


# -- layers ---------------------------------------------------------------------------


def _without_ingestion_time(df: DataFrame) -> DataFrame:
    return df.drop(INGESTED_AT)


def write_raw_csv(t: Tables, root: str, name: str) -> None:
    """Write a derived table the way raw files arrive: CSV with a header, compressed."""
    (
        t.raw(name)
        .drop(ROW_ORDER)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 1_000_000)  # such files cannot be split
        .csv(raw_path(root, name))
    )


def bronze_ingest(t: Tables) -> DataFrame:
    root = t.staging.new_path("root")
    write_raw_csv(t, root, "customers")
    return ingest(t.spark, root, "customers", NOW).drop(ROW_ORDER, INGESTED_AT)


def parquet_round_trip(t: Tables) -> DataFrame:
    path = t.staging.new_path("payments")
    write_parquet(t.raw("payments"), path)
    return read_parquet(t.spark, path)


def _build_everything(t: Tables, prefix: str) -> str:
    root = t.staging.new_path("root")
    for name in TABLES:
        write_raw_csv(t, root, name)
    run(t.spark, root, NOW, prefix)
    return root


def _labeled(layer: str, counts: DataFrame) -> DataFrame:
    return counts.select(F.lit(layer).alias("layer"), "table", "rows")


def _clean_up(t: Tables, counts: DataFrame, prefix: str) -> DataFrame:
    """Take the counts, a row per table, and leave no files or schemas behind."""
    rows = counts.collect()
    unpublish(t.spark, prefix)
    t.staging.drop()
    return t.spark.createDataFrame(rows, counts.schema)


def layer_row_counts(t: Tables) -> DataFrame:
    """The whole build from CSV files, and the rows each layer ends up with."""
    prefix = "sluice_layers_"
    root = _build_everything(t, prefix)
    root = current(t.spark, root)
    gold_tables = {n.removeprefix("gold_"): df for n, df in load_gold(t.spark, root).items()}
    result = _labeled("gold", count_rows(gold_tables))
    for layer in (BRONZE, SILVER, QUARANTINE):
        tables = {name: read_table(t.spark, root, layer, name) for name in TABLES}
        result = result.unionByName(_labeled(layer, count_rows(tables)))
    return _clean_up(t, result, prefix)


def published_tables(t: Tables) -> DataFrame:
    """Row counts of all published tables, read through the catalog."""
    prefix = "sluice_check_"
    root = _build_everything(t, prefix)
    unpublish(t.spark, prefix)  # as in a session that has built nothing
    published = attach(t.spark, root, prefix)
    counts = count_rows({name.removeprefix(prefix): df for name, df in published.items()})
    parts = F.split("table", "[.]")
    return _clean_up(t, counts.select(parts[0].alias("layer"), parts[1].alias("table"), "rows"), prefix)


# -- Gold -----------------------------------------------------------------------------


def sales_lines(t: Tables) -> DataFrame:
    orders, items = t.silver_once("orders"), t.silver_once("order_items")
    lines = gold.sales_lines(orders, items, t.staging, t.judged("order_items").rows)
    return _without_ingestion_time(lines)


def sales_by_state(t: Tables) -> DataFrame:
    names = ("orders", "order_items", "customers")
    return gold.build_sales_by_state(*(t.silver_once(name) for name in names))


def product_performance(t: Tables) -> DataFrame:
    return gold.build_product_performance(
        t.silver("orders"), t.silver("order_items"), t.silver("products"), t.silver("reviews")
    )


def _in_order(df: DataFrame) -> DataFrame:
    """The rows of a small sorted table with their place in it."""
    return df.withColumn("_id", F.monotonically_increasing_id()).select(
        F.row_number().over(Window.orderBy("_id")).cast("bigint").alias("place"), *df.columns
    )


def customer_segments(t: Tables) -> DataFrame:
    names = ("orders", "order_items", "customers")
    return gold.build_customer_segments(*(t.silver_once(name) for name in names), t.staging)


def rfm_cut_points(t: Tables) -> DataFrame:
    facts = gold.order_facts(t.silver_once("orders"), t.silver_once("order_items"))
    activity = t.staging.pin(gold.customer_activity(facts), "activity")
    metrics = ["recency_days", "frequency", "monetary"]
    edges = gold.rfm_cut_points(activity).unpivot([], metrics, "metric", "edges")
    return edges.select("metric", *(F.get("edges", F.lit(i)).alias(f"q{i + 1}") for i in range(3)))


def monthly_kpis(t: Tables) -> DataFrame:
    names = ("orders", "order_items", "reviews")
    return gold.build_monthly_kpis(*(t.silver_once(name) for name in names))


# -- exploration ----------------------------------------------------------------------


def profile_distinct_values(t: Tables) -> DataFrame:
    return profile.distinct_values(t.raw("products"), "category")


def profile_value_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.raw("orders"), "status", normalize_text=True)


def profile_sample(t: Tables) -> DataFrame:
    """What holds for any sample: repeatable, rows of the table, about a tenth of them."""
    orders = source(t.spark, t.sf_dir, "orders")
    sample, again = profile.sample(orders), profile.sample(orders)
    foreign = sample.exceptAll(orders).agg(F.count(F.lit(1)).alias("foreign_rows"))
    changed = sample.exceptAll(again).agg(F.count(F.lit(1)).alias("changed_rows"))
    sizes = orders.agg(F.count(F.lit(1)).alias("table_rows")).crossJoin(sample.agg(F.count(F.lit(1)).alias("_n")))
    share = F.col("_n") / F.col("table_rows")
    # Four standard deviations of a tenth.
    width = 4 * F.sqrt(F.lit(0.09) / F.col("table_rows"))
    return (
        sizes.crossJoin(foreign)
        .crossJoin(changed)
        .select("table_rows", "foreign_rows", "changed_rows", (F.abs(share - 0.1) <= width).alias("share_fits"))
    )


def profile_head(t: Tables) -> DataFrame:
    return profile.head(source(t.spark, t.sf_dir, "orders"), order_by="o_orderkey")


def _part(split: Callable[[Tables], splits.Split], index: int) -> Callable[[Tables], DataFrame]:
    return lambda t: split(t)[index]


def _silver(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: _without_ingestion_time(t.silver(name))


def _quarantine(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: _without_ingestion_time(t.classified(name).quarantine())


def _quality(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: t.classified(name).quality(NOW).drop("executed_at")


BODIES: dict[str, Callable[[Tables], DataFrame]] = {
    "strip_strings": strip_strings,
    "lowercase": lowercase,
    "uppercase": uppercase,
    "parse_datetime": parse_datetime,
    "parse_datetime_pattern": parse_datetime_pattern,
    "cast_float": cast_float,
    "cast_int": cast_int,
    "nullify_outside_range": nullify_outside_range,
    "split_outside_range_kept": _part(_range_split, 0),
    "split_outside_range_rejected": _part(_range_split, 1),
    "nullify_not_in_set": _part(_category_split, 0),
    "nullify_not_in_set_audit": _part(_category_split, 1),
    "drop_null_keys_kept": _part(_null_split, 0),
    "drop_null_keys_rejected": _part(_null_split, 1),
    "split_orphans_kept": _part(_orphan_split, 0),
    "split_orphans_orphans": _part(_orphan_split, 1),
    "dedup_latest": _part(_latest_split, 0),
    "dedup_latest_removed": _part(_latest_split, 1),
    "dedup_first": _part(_first_split, 0),
    "dedup_first_removed": _part(_first_split, 1),
    "quarantine_union": quarantine_union,
    **{f"silver_{name}": _silver(name) for name in TABLES},
    **{f"quarantine_{name}": _quarantine(name) for name in TABLES},
    **{f"quality_{name}": _quality(name) for name in TABLES},
    "quality_checks": quality_checks,
    "null_counts": null_counts,
    "duplicate_check": duplicate_check,
    "accepted_values_check": accepted_values_check,
    "row_count_check": row_count_check,
    **{f"contract_violations_{name}": _contract(Tables.silver, name) for name in TABLES},
    **{f"contract_violations_typed_{name}": _contract(_typed, name) for name in TABLES},
    "contract_shape": contract_shape,
    "contract_raises": contract_raises,
    "contract_gate": contract_gate,
    "bronze_ingest": bronze_ingest,
    "parquet_round_trip": parquet_round_trip,
    "sales_lines": sales_lines,
    "sales_by_state": sales_by_state,
    "product_performance": product_performance,
    "customer_segments": customer_segments,
    "rfm_cut_points": rfm_cut_points,
    "monthly_kpis": monthly_kpis,
    "sales_by_state_order": lambda t: _in_order(sales_by_state(t)),
    "monthly_kpis_order": lambda t: _in_order(monthly_kpis(t)),
    "published_tables": published_tables,
    "layer_row_counts": layer_row_counts,
    "profile_distinct_values": profile_distinct_values,
    "profile_value_counts": profile_value_counts,
    "profile_sample": profile_sample,
    "profile_head": profile_head,
}

QUERIES: dict[str, Query] = {name: _query(body) for name, body in BODIES.items()}
