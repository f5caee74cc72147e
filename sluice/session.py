"""A SparkSession with the settings this package is tuned for.

Nothing in the package depends on these settings for its results: sessions made
elsewhere work as well.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Recording the Python call site of every expression costs more than planning it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "sluice", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or fetch) a session; `settings` uses `__` for the dots of a Spark key.

    On a cluster leave `master` to spark-submit and size
    `spark.sql.shuffle.partitions` so that a shuffled partition stays near 128 MB;
    adaptive execution merges the ones that turn out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = SETTINGS | {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
