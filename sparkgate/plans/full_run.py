"""A whole run over the landing folder: three jobs in dependency order, then registration."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from sparkgate.errors import StorageWriteError
from sparkgate.functions.names import archive_folder
from sparkgate.plans.jobs import run_order_items, run_orders, run_products
from sparkgate.schemas import SCHEMA_REGISTRY
from sparkgate.settings import RunSettings
from sparkgate.sources import hadoop
from sparkgate.sources.catalog import register_table
from sparkgate.sources.tables import table_exists


def run_all(
    spark: SparkSession,
    settings: RunSettings,
    *,
    trigger_file: str | None = None,
    **options,
) -> dict[str, dict[str, int]]:
    """Products beside orders then order items; then register the tables, then archive.

    The two branches share no data, so each has a thread of the driver to submit its Spark jobs
    from. A failing branch fails the run, and then nothing is registered or archived. The
    trigger file, the arrival that started the run, is moved to the archive at the very end.
    """

    def products_branch() -> dict[str, dict[str, int]]:
        return {"products": run_products(spark, settings, **options)}

    def orders_branch() -> dict[str, dict[str, int]]:
        return {
            "orders": run_orders(spark, settings, **options),
            "order_items": run_order_items(spark, settings, **options),
        }

    with ThreadPoolExecutor(max_workers=2) as pool:
        branches = [
            pool.submit(inheritable_thread_target(spark)(branch))
            for branch in (products_branch, orders_branch)
        ]
        summary = {table: counts for done in branches for table, counts in done.result().items()}

    for table in SCHEMA_REGISTRY:
        path = settings.storage.table_path(table)
        if table_exists(spark, path):
            register_table(spark, f"{settings.database}.{table}", path)
    if trigger_file is not None:
        archive_file(spark, trigger_file, settings.storage.archive_path)
    return summary


def archive_file(spark: SparkSession, file: str, archive_path: str) -> str:
    """Move one processed file under the archive's folder for today (UTC); its new location."""
    folder = archive_folder(datetime.now(timezone.utc).date())
    destination = f"{archive_path.rstrip('/')}/{folder}/{file.rpartition('/')[2]}"
    try:
        moved = hadoop.move(spark, file, destination)
    except Exception as error:
        raise StorageWriteError(f"cannot archive {file}: {error}", location=file) from error
    if not moved:
        raise StorageWriteError(f"cannot archive {file} as {destination}", location=file)
    return destination
