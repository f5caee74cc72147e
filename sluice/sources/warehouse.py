"""Publishing the layers as catalog tables, to be queried with `spark.sql`.

Tables are external: publishing registers the files and copies nothing. Bronze is not
published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.config import (
    GOLD,
    GOLD_TABLES,
    QUALITY,
    QUARANTINE,
    SILVER,
    TABLES,
    table_path,
)
from sluice.sources.staging import together
from sluice.sources.store import load_quality, write_parquet
from sluice.sources.versions import current

SCHEMAS = (SILVER, QUARANTINE, GOLD, QUALITY)
CHECKS = "checks"


def point_table(spark: SparkSession, table: str, path: str) -> None:
    """Point the table name at a Parquet location, in one step if the table is there.

    A table of that name with other columns makes way for the new one.
    """
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == spark.read.parquet(path).schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet")


def manifest(root: str) -> dict[str, dict[str, str]]:
    """Schema -> table name -> location of everything that is published."""
    return {
        SILVER: {name: table_path(root, SILVER, name) for name in TABLES},
        QUARANTINE: {name: table_path(root, QUARANTINE, name) for name in TABLES},
        GOLD: {name.removeprefix("gold_"): table_path(root, GOLD, name) for name in GOLD_TABLES},
        QUALITY: {CHECKS: table_path(root, "warehouse", CHECKS)},
    }


def write_checks(spark: SparkSession, root: str) -> None:
    """Gather the quality rows of all tables in one table of the store at `root`."""
    write_parquet(load_quality(spark, root).coalesce(1), table_path(root, "warehouse", CHECKS))


def publish(spark: SparkSession, root: str, prefix: str = "", home: str | None = None) -> dict[str, DataFrame]:
    """Register all tables of the store at `root`, and drop the names nothing stands for.

    `prefix` goes in front of the schema names; `home` is where their folders are, `root`
    unless given. Returns the tables by qualified name.
    """
    home = (home or root).rstrip("/")
    paths = {}
    for schema, tables in manifest(root).items():
        schema = f"{prefix}{schema}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{home}/warehouse/{schema}'")
        for stale in spark.catalog.listTables(schema):
            if stale.name not in tables and not stale.isTemporary:
                spark.sql(f"DROP TABLE IF EXISTS {schema}.{stale.name}")
        paths |= {f"{schema}.{name}": path for name, path in tables.items()}
    together(lambda table: point_table(spark, table, paths[table]), list(paths))
    return {table: spark.table(table) for table in paths}


def attach(spark: SparkSession, root: str, prefix: str = "") -> dict[str, DataFrame]:
    """Register the tables of the newest finished build below `root`, without building.

    The files last; the names last as long as the session's catalog: with a persistent one
    (`spark.sql.catalogImplementation=hive` and a metastore) they need no second attaching.
    """
    return publish(spark, current(spark, root), prefix, root)


def unpublish(spark: SparkSession, prefix: str = "") -> None:
    """Forget the published schemas; the files stay."""
    for schema in SCHEMAS:
        spark.sql(f"DROP SCHEMA IF EXISTS {prefix}{schema} CASCADE")
