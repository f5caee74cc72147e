import threading
import time

import pytest

from sluice.sources import versions as v
from sluice.sources.store import create_file, exists, list_names


def start(spark, root):
    version = v.new_version(root)
    create_file(spark, f"{version}/silver/part-0")
    return version


def test_a_newer_finished_build_spares_one_that_still_runs(spark, tmp_path):
    root = str(tmp_path)
    older, newer = start(spark, root), start(spark, root)
    with v.Lease(spark, older):
        with v.Lease(spark, newer):
            v.finish(spark, root, newer)
        assert v.current(spark, root) == newer
        assert exists(spark, f"{older}/silver/part-0")
        v.finish(spark, root, older)
    # The late one is whole and marked, but readers stay with the newer one.
    assert v.current(spark, root) == newer and exists(spark, f"{older}/silver/part-0")
    assert list_names(spark, f"{root}/{v.LEASES}") == []


def test_failed_builds_are_removed_by_the_next_one(spark, tmp_path):
    root = str(tmp_path)
    failed = start(spark, root)
    with pytest.raises(ZeroDivisionError), v.Lease(spark, failed):
        raise ZeroDivisionError
    done = start(spark, root)
    v.finish(spark, root, done)
    assert list_names(spark, f"{root}/{v.RUNS}") == [done.rsplit("/", 1)[1]]


def test_a_build_whose_lease_ran_out_is_not_marked(spark, tmp_path):
    root = str(tmp_path)
    slow, other = start(spark, root), start(spark, root)
    lease = v.Lease(spark, slow)
    assert v.abandoned(spark, root) == [other.rsplit("/", 1)[1]]
    v.finish(spark, root, other, now=time.time() + v.LEASE_SECONDS + 60)
    assert not exists(spark, slow)
    with pytest.raises(v.LostLease):
        v.finish(spark, root, slow)
    lease.close()
    assert v.current(spark, root) == other


def test_leases_are_renewed(spark, tmp_path):
    version = start(spark, str(tmp_path))
    path = tmp_path / v.LEASES / version.rsplit("/", 1)[1]
    with v.Lease(spark, version, renew=0.05):
        first = path.stat().st_mtime_ns
        deadline = time.time() + 10
        while path.stat().st_mtime_ns == first and time.time() < deadline:
            time.sleep(0.02)
        assert path.stat().st_mtime_ns > first


def test_overlapping_builds_leave_one_whole_version(spark, tmp_path):
    root, failures = str(tmp_path), []

    def build(seconds):
        version = v.new_version(root)
        try:
            with v.Lease(spark, version):
                for i in range(5):
                    create_file(spark, f"{version}/silver/part-{i}")
                    time.sleep(seconds)
                v.finish(spark, root, version)
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    builders = [threading.Thread(target=build, args=(s,)) for s in (0.2, 0.0, 0.05, 0.1)]
    for builder in builders:
        builder.start()
    for builder in builders:
        builder.join()
    assert not failures
    assert len(list_names(spark, f"{v.current(spark, root)}/silver")) == 5
    assert len(list_names(spark, f"{root}/{v.RUNS}")) == v.KEPT


def test_finished_once(spark, tmp_path):
    version = start(spark, str(tmp_path))
    v.finish(spark, str(tmp_path), version)
    with pytest.raises(v.LostLease):
        v.finish(spark, str(tmp_path), version)
