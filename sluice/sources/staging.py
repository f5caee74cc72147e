"""Intermediate results as Parquet in the folder all executors share.

A staged table cuts the lineage, survives the loss of executors, and gives the
optimizer real file sizes, so that it broadcasts a table only when that is small.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from itertools import count
from typing import TypeVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from sluice.sources.store import delete, make_temporary

Item, Result = TypeVar("Item"), TypeVar("Result")

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="sluice-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Staging:
    """A private folder for the staged tables of one run.

    As a context manager it removes the folder at the end. Otherwise the folder stays
    until the application ends, because lazy DataFrames still read from it.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.path = f"{root or shared_folder(spark)}/sluice-{uuid4().hex}"
        self._numbers = count()
        make_temporary(spark, self.path)

    def new_path(self, name: str) -> str:
        return f"{self.path}/{name}-{next(self._numbers)}"

    def pin(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        """Write `df` once and return the written table; `codec` replaces the session's."""
        path = self.new_path(name)
        df.write.options(**({"compression": codec} if codec else {})).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        delete(self.spark, self.path)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go when it ends.

    Otherwise they stay until the driver happens to collect its garbage: those of a long build
    add up.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def together(job: Callable[[Item], Result], items: Sequence[Item]) -> list[Result]:
    """Run independent Spark jobs side by side, so that they share the executors."""
    if len(items) < 2:
        return [job(item) for item in items]
    with ThreadPoolExecutor(len(items)) as pool:
        return list(pool.map(job, items))
