"""Reading raw delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file (or a directory of them) with a header, every column as text.

    Empty fields are null. Rows with too many or too few fields, and files whose header
    differs, raise instead of losing data.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .csv(path)
    )
