"""The whole build: Bronze, Silver, Gold, and the published tables."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Collection
from datetime import datetime

from pyspark.sql import SparkSession

from sluice.config import TABLES
from sluice.plans.bronze import MULTI_LINE_TABLES, build_bronze
from sluice.plans.gold import build_gold
from sluice.plans.silver import build_silver
from sluice.session import build_session
from sluice.sources.staging import Staging, shuffles_dropped, together
from sluice.sources.versions import Lease, finish, new_version
from sluice.sources.warehouse import attach, write_checks

log = logging.getLogger("sluice")

# Tables of a wave only need the Silver of earlier waves, so they can run together.
SILVER_WAVES = (("customers", "products"), ("orders",), ("order_items", "payments", "reviews"))


def build_all_silver(spark: SparkSession, root: str, staging: Staging, executed_at: datetime) -> None:
    for wave in SILVER_WAVES:
        together(lambda name: build_silver(spark, root, name, staging, executed_at), wave)
        log.info("silver done: %s", ", ".join(wave))


def run(
    spark: SparkSession,
    root: str,
    now: datetime | None = None,
    prefix: str = "",
    multi_line: Collection[str] = MULTI_LINE_TABLES,
) -> None:
    """Build every layer under `root` from `<root>/raw/<table>.csv` and publish it.

    `multi_line` names the tables whose quoted text may contain line breaks.

    The layers go to a version of their own that readers see once all of it is there; see
    `versions`. Staged tables go below `root` as well, which all executors can reach, and
    are removed at the end.
    """
    now = now or datetime.now()
    staging_root = f"{root.rstrip('/')}/_staging"
    version = new_version(root)
    with Lease(spark, version), shuffles_dropped(spark):
        together(lambda name: build_bronze(spark, root, name, now, version, name in multi_line), TABLES)
        log.info("bronze done: %d tables", len(TABLES))
        with Staging(spark, staging_root) as staging:
            build_all_silver(spark, version, staging, now)
            log.info("gold done: %d tables", len(build_gold(spark, version, staging)))
        write_checks(spark, version)
        finish(spark, root, version)
    log.info("published: %d tables", len(attach(spark, root, prefix)))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("root", help="URI of the data folder that holds raw/<table>.csv")
    parser.add_argument(
        "--multi-line", nargs="*", choices=TABLES, default=sorted(MULTI_LINE_TABLES), help="tables with line breaks in text"
    )
    arguments = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    run(build_session(), arguments.root, multi_line=arguments.multi_line)


if __name__ == "__main__":
    main()
