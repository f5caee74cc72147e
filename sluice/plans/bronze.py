"""Bronze: raw CSV as text, plus where and when each row came from."""

from __future__ import annotations

import warnings
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import BRONZE, INGESTED_AT, ROW_ORDER, SOURCE_FILE, raw_path, table_path
from sluice.operators.quality import timestamp_literal
from sluice.sources.raw import read_csv_raw
from sluice.sources.store import file_sizes, read_table, write_parquet

# Text that may contain line breaks. Such files cannot be split, so large tables of this
# kind should be landed as many files. Tables that are not named are read line by line.
MULTI_LINE_TABLES = frozenset({"reviews", "products"})
LARGEST_UNSPLIT = 1 << 30  # bytes that one task should read at most
CODEC = "zstd"  # text with lineage is the largest layer, and is read once a build


def row_order() -> F.Column:
    """The row's place in its source: file, start of the split in it, row in the split.

    The generated id alone is no file order, since Spark packs splits by size.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def ingest(
    spark: SparkSession, root: str, name: str, ingested_at: datetime, multi_line: bool | None = None
) -> DataFrame:
    """A raw table as text with its lineage columns. Works for any table.

    `multi_line` says whether quoted text may contain line breaks, MULTI_LINE_TABLES
    unless given. Then a file is read by one task; larger ones than LARGEST_UNSPLIT raise
    a warning that names them.
    """
    multi_line = name in MULTI_LINE_TABLES if multi_line is None else multi_line
    if multi_line:
        large = [path for path, size in file_sizes(spark, raw_path(root, name)) if size > LARGEST_UNSPLIT]
        if large:
            warnings.warn(
                f"files that one task has to read, since {name} may contain line breaks: {', '.join(large)}; "
                "land them in parts, or pass multi_line=False if no text contains line breaks",
                stacklevel=2,
            )
    raw = read_csv_raw(spark, raw_path(root, name), multi_line=multi_line)
    return raw.select(
        "*",
        F.lit(f"{name}.csv").alias(SOURCE_FILE),
        timestamp_literal(ingested_at).alias(INGESTED_AT),
        row_order().alias(ROW_ORDER),
    )


def build_bronze(
    spark: SparkSession,
    root: str,
    name: str,
    ingested_at: datetime,
    target: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Land the raw files below `root` in the store at `target`, which is `root` unless given."""
    target = target or root
    write_parquet(ingest(spark, root, name, ingested_at, multi_line), table_path(target, BRONZE, name), CODEC)
    return read_table(spark, target, BRONZE, name)
