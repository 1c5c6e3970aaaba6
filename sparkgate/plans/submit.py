"""Entry for spark-submit: one table's job, or all of them, from command-line arguments.

    spark-submit submit.py orders --JOB_NAME=orders-etl --ENVIRONMENT=dev --RAW_BUCKET=... ...

Exit code 1 on failure, so that an outer scheduler can tell.
"""

from __future__ import annotations

import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from sparkgate.errors import ConfigurationError
from sparkgate.plans.jobs import run_order_items, run_orders, run_products
from sparkgate.settings import settings_from_args

logger = logging.getLogger(__name__)

JOBS = {"products": run_products, "orders": run_orders, "order_items": run_order_items}


def parse_args(argv: Sequence[str]) -> tuple[str, dict[str, str]]:
    """The table, and the arguments given as --NAME=value or --NAME value."""
    if not argv or argv[0] not in JOBS:
        raise ConfigurationError(f"the first argument must be one of {', '.join(JOBS)}")
    args, rest = {}, list(argv[1:])
    while rest:
        name, equals, value = rest.pop(0).partition("=")
        if not name.startswith("--"):
            raise ConfigurationError(f"not an argument: {name!r}")
        if not equals:
            if not rest:
                raise ConfigurationError(f"argument {name} has no value")
            value = rest.pop(0)
        args[name.removeprefix("--")] = value
    return argv[0], args


def main(argv: Sequence[str]) -> int:
    """Run the job the arguments name; 0 when it succeeded."""
    try:
        table, args = parse_args(argv)
        settings = settings_from_args(args)
        spark = SparkSession.builder.appName(settings.job_name).getOrCreate()
        counts = JOBS[table](spark, settings)
    except Exception:
        logger.exception("job failed")
        return 1
    logger.info("%s: %s", table, counts)
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main(sys.argv[1:]))
