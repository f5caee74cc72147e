"""Runs of the whole build as versions side by side, with a marker for each finished one.

A run writes all its tables below `<root>/runs/<name>` and marks it as done at the end, by
creating one small file. The newest mark names the version that readers see. So a reader
sees all tables of one run, whatever happens to a later run before its mark.

Builds may overlap. Each holds a lease, `<root>/_lease/<name>`, that it renews while it
works; another build's folder is only removed when its lease is gone or has run out. Whether
a run is finished or given up is decided once: by whoever creates `<root>/_claim/<name>`. A
build that finishes after a newer one is marked as well, but readers stay with the newer one.
"""

from __future__ import annotations

import threading
import time
from uuid import uuid4

from pyspark.sql import SparkSession

from sluice.sources.store import create_file, create_new, delete, list_files, list_names

RUNS, DONE, LEASES, CLAIMS = "runs", "_done", "_lease", "_claim"
KEPT = 2  # finished versions: the newest one, and the one that readers may still have open
LEASE_SECONDS = 6 * 3600  # a build that was silent for so long counts as failed
RENEW_SECONDS = 600


class LostLease(RuntimeError):
    """Another build took this one for failed and may have removed its files."""


def new_version(root: str) -> str:
    """The folder of a run that is about to start. Names sort by time."""
    return f"{root.rstrip('/')}/{RUNS}/{time.time_ns():020d}-{uuid4().hex[:8]}"


def _split(version: str) -> tuple[str, str]:
    root, _, name = version.rsplit("/", 2)
    return root, name


class Lease:
    """Says that a run is still being built; renewed in the background until it is closed."""

    def __init__(self, spark: SparkSession, version: str, renew: float = RENEW_SECONDS) -> None:
        root, name = _split(version)
        self._spark, self._path = spark, f"{root}/{LEASES}/{name}"
        create_file(spark, self._path)
        self._closed = threading.Event()
        self._thread = threading.Thread(target=self._keep, args=(renew,), daemon=True)
        self._thread.start()

    def _keep(self, renew: float) -> None:
        while not self._closed.wait(renew):
            create_file(self._spark, self._path)  # a new file: its time starts again

    def close(self) -> None:
        self._closed.set()
        self._thread.join()
        delete(self._spark, self._path)

    def __enter__(self) -> Lease:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def abandoned(spark: SparkSession, root: str, now: float | None = None) -> list[str]:
    """Names of runs without a mark that nobody is building any more."""
    root = root.rstrip("/")
    now = time.time() if now is None else now
    # In this order: a run that is marked or leased meanwhile is only ever spared.
    runs = list_names(spark, f"{root}/{RUNS}")
    held = {name for name, at in list_files(spark, f"{root}/{LEASES}") if now - at < LEASE_SECONDS}
    marks = set(list_names(spark, f"{root}/{DONE}"))
    return [name for name in runs if name not in held and name not in marks]


def finish(spark: SparkSession, root: str, version: str, now: float | None = None) -> None:
    """Mark `version` as done, and remove what neither readers nor builders need.

    A run that was given up meanwhile, because its lease ran out, has lost its files and is
    not marked: `LostLease`. A claimed run whose builder died before the mark stays.
    """
    root, name = root.rstrip("/"), version.rsplit("/", 1)[1]
    if not create_new(spark, f"{root}/{CLAIMS}/{name}"):
        raise LostLease(f"{version} was given up by another build, or is finished")
    create_file(spark, f"{root}/{DONE}/{name}")
    marks = sorted(list_names(spark, f"{root}/{DONE}"))
    for old in marks[:-KEPT]:
        for folder in (DONE, RUNS, CLAIMS):
            delete(spark, f"{root}/{folder}/{old}")
    for old in abandoned(spark, root, now):
        if create_new(spark, f"{root}/{CLAIMS}/{old}"):
            delete(spark, f"{root}/{RUNS}/{old}")
            delete(spark, f"{root}/{LEASES}/{old}")


def current(spark: SparkSession, root: str) -> str:
    """The folder of the newest finished run: a root for the readers of the store."""
    root = root.rstrip("/")
    marks = list_names(spark, f"{root}/{DONE}")
    if not marks:
        raise FileNotFoundError(f"no finished build below {root}")
    return f"{root}/{RUNS}/{max(marks)}"
