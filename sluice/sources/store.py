"""The layered Parquet store: reading, writing, and swapping finished tables in."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.config import GOLD, GOLD_TABLES, QUALITY, SILVER, TABLES, table_path


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path. Needs classic Spark: Spark Connect has no JVM handle."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file, which appears at once."""
    fs, target = _file_system(spark, path)
    fs.create(target, True).close()


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file if there is none yet; whether this call created it.

    At most one of several callers succeeds where the file system creates files atomically.
    """
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        return False
    try:
        fs.create(target, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True


def list_files(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, time of the last change in seconds) of what is in a folder."""
    fs, target = _file_system(spark, path)
    found = fs.listStatus(target) if fs.exists(target) else []
    return [(item.getPath().getName(), item.getModificationTime() / 1000) for item in found]


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no folder."""
    fs, target = _file_system(spark, path)
    return [item.getPath().getName() for item in fs.listStatus(target)] if fs.exists(target) else []


def file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files directly in a folder."""
    fs, target = _file_system(spark, path)
    found = fs.listStatus(target) if fs.exists(target) else []
    return [(item.getPath().toString(), item.getLen()) for item in found if item.isFile()]


def make_temporary(spark: SparkSession, path: str) -> None:
    """Create a folder that is removed when the application ends."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)


def _aside(path: str) -> str:
    """Where a table waits while another one takes its place."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    return f"{folder}/_old_{name}"


def standing(spark: SparkSession, path: str) -> str:
    """Where a table's files are: its own path, or where they wait during or after a broken swap."""
    return _aside(path) if not exists(spark, path) and exists(spark, _aside(path)) else path


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _file_system(spark, source)
    _, target_path = _file_system(spark, target)
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not move {source} to {target}")


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a finished table directory to `target`, taking the old one's place.

    The old one steps aside and goes at the end. Wherever this stops, one whole table is
    left, and `standing` says where.
    """
    fs, target_path = _file_system(spark, target)
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path):
        delete(spark, _aside(target))
        _rename(spark, target, _aside(target))
    _rename(spark, source, target)
    delete(spark, _aside(target))


def pending(path: str) -> str:
    """Where a table is written before it takes its place; readers skip `_` folders."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    return f"{folder}/_pending_{name}"


def write_parquet(df: DataFrame, path: str, codec: str | None = None) -> None:
    """Write a whole table, replacing what is there only once the write succeeded.

    `codec` replaces the session's.
    """
    df.write.options(**({"compression": codec} if codec else {})).mode("overwrite").parquet(pending(path))
    move_folder(df.sparkSession, pending(path), path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A whole table. With a known schema no file is opened before the data is needed."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table(
    spark: SparkSession, root: str, layer: str, name: str, schema: StructType | None = None
) -> DataFrame:
    return read_parquet(spark, standing(spark, table_path(root, layer, name)), schema)


def read_keys(spark: SparkSession, root: str, name: str, key: str) -> DataFrame:
    """The primary keys of a Silver table: a one-column scan."""
    schema = StructType([StructField(key, StringType())])
    return read_table(spark, root, SILVER, name, schema)


def load_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All Silver tables, lazily, by name."""
    return {name: read_table(spark, root, SILVER, name) for name in TABLES}


def load_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, GOLD, name) for name in GOLD_TABLES}


def load_quality(spark: SparkSession, root: str) -> DataFrame:
    """The quality rows of every table in one frame."""
    return spark.read.parquet(*(table_path(root, QUALITY, name) for name in TABLES))


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table with its row count, in a single job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
