"""The table jobs: read, validate, quarantine, gate, upsert, metrics."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.functions.names import is_items_workbook, is_orders_workbook
from sparkgate.operators.rules import ValidationRule
from sparkgate.operators.validation import DataQualityValidator, check_threshold
from sparkgate.plans.rule_sets import order_items_rules, orders_rules, products_rules
from sparkgate.schemas import ORDERS_SCHEMA, PARTITION_COLS, PRIMARY_KEYS, SCHEMA_REGISTRY
from sparkgate.settings import RunSettings
from sparkgate.sources.excel import read_workbooks
from sparkgate.sources.landing import read_csv
from sparkgate.sources.quarantine import write_to_quarantine
from sparkgate.sources.run_metrics import emit_job_metrics, emit_run_event
from sparkgate.sources.staging import StagingArea
from sparkgate.sources.tables import (
    create_table_if_not_exists,
    published_batch,
    read_table,
    write_table_merge,
)

logger = logging.getLogger(__name__)

# Files of a registered table without partitions.
BUCKETS = 16
EMPTY_SUMMARY = {"total": 0, "valid": 0, "rejected": 0, "inserted": 0, "updated": 0}


@dataclass(frozen=True)
class TableJob:
    """What distinguishes one table's job from another's."""

    table: str
    schema: T.StructType
    keys: Sequence[str]
    partition_cols: Sequence[str]
    rules: Sequence[ValidationRule]
    order_by: Sequence[str] = field(default=())
    # Files of a table without partitions, by hash of its keys; 0 leaves it to Spark.
    buckets: int = 0


def table_job(table: str, rules: Sequence[ValidationRule]) -> TableJob:
    """Job description of a registered table."""
    return TableJob(
        table=table,
        schema=SCHEMA_REGISTRY[table],
        keys=PRIMARY_KEYS[table],
        partition_cols=PARTITION_COLS[table],
        rules=rules,
        buckets=0 if PARTITION_COLS[table] else BUCKETS,
    )


def run_table_job(
    spark: SparkSession,
    job: TableJob,
    settings: RunSettings,
    read_source: Callable[[], DataFrame],
    *,
    table_path: str | None = None,
    quarantine_base_path: str | None = None,
    metrics_path: str | None = None,
    events_path: str | None = None,
    run_date: str | None = None,
    replace_quarantine: bool = False,
    batch_id: str | None = None,
) -> dict[str, int]:
    """Run one table's job and return its counts.

    Rejects are quarantined before the gate is checked, so they can be inspected when it fails;
    the target changes only after it. The source is read once, into staging, and so are the rules
    evaluated: counting, quarantining and merging read the stored labelled rows.

    batch_id names the delivery, if it may come again: a batch whose merge was published is not
    loaded a second time, and has one row of metrics and one event however often it is replayed.
    """
    started = time.monotonic()
    storage = settings.storage
    table_path = table_path or storage.table_path(job.table)
    quarantine_base_path = quarantine_base_path or storage.quarantine_base_path
    metrics_path = metrics_path or storage.metrics_path
    events_path = events_path or storage.events_path
    run_date = run_date or datetime.now(timezone.utc).date().isoformat()
    about = {
        "job_name": settings.job_name,
        "environment": settings.environment,
        "execution_id": settings.execution_id,
        "table": job.table,
    }

    def report(entry: Mapping) -> dict[str, int]:
        """Metrics and event of a published merge, once per batch; its counts."""
        counts = entry["details"]
        emit_job_metrics(
            spark,
            metrics_path,
            job_name=settings.job_name,
            environment=settings.environment,
            records_in=counts["total"],
            records_valid=counts["valid"],
            records_rejected=counts["rejected"],
            rows_inserted=entry["rows_inserted"],
            rows_updated=entry["rows_updated"],
            duration_ms=int((time.monotonic() - started) * 1000),
            once=batch_id,
        )
        emit_run_event(
            spark,
            events_path,
            level="INFO",
            event="JOB_COMPLETE",
            records_in=counts["total"],
            records_rejected=counts["rejected"],
            once=batch_id,
            **about,
        )
        return {**counts, "inserted": entry["rows_inserted"], "updated": entry["rows_updated"]}

    try:
        if batch_id is not None:
            published = published_batch(spark, table_path, batch_id)
            if published is not None:
                return report(published)
        with StagingArea(spark, job.table) as staging:
            # Stored once, so that all that looks at it sees the same rows.
            source = staging.write(read_source(), "source")
            result = DataQualityValidator(
                job.rules, logger, order_by=job.order_by, look_ahead=True, staging=staging
            ).validate(source)
            if result.total_records == 0:
                logger.warning("%s: no records in source, nothing done", job.table)
                return dict(EMPTY_SUMMARY)

            if result.records_failed:
                write_to_quarantine(
                    result.invalid_df,
                    quarantine_base_path,
                    job.table,
                    settings.execution_id,
                    run_date,
                    replace=replace_quarantine,
                    rows=result.records_failed,
                )
            check_threshold(result, settings.max_quarantine_ratio)

            create_table_if_not_exists(
                spark, job.schema, table_path, job.partition_cols,
                keys=job.keys if job.buckets else (), buckets=job.buckets,
            )
            counts = {
                "total": result.total_records,
                "valid": result.records_passed,
                "rejected": result.records_failed,
            }
            merged = write_table_merge(
                spark, result.valid_df, table_path, job.keys, stored=True, batch_id=batch_id, details=counts
            )
    except Exception as error:
        emit_run_event(
            spark, events_path, level="ERROR", event="JOB_FAILED", message=str(error), **about
        )
        raise

    return report({"details": counts, "rows_inserted": merged.rows_inserted, "rows_updated": merged.rows_updated})


def run_products(
    spark: SparkSession,
    settings: RunSettings,
    *,
    source_df: DataFrame | None = None,
    source_path: str | None = None,
    **options,
) -> dict[str, int]:
    """Products job over CSV files, or over source_df. Options are those of run_table_job."""
    job = table_job("products", products_rules())

    def read_source() -> DataFrame:
        if source_df is not None:
            return source_df
        return read_csv(spark, source_path or settings.storage.incoming_path, job.schema)

    return run_table_job(spark, job, settings, read_source, **options)


def run_orders(
    spark: SparkSession,
    settings: RunSettings,
    *,
    source_df: DataFrame | None = None,
    source_path: str | None = None,
    **options,
) -> dict[str, int]:
    """Orders job over workbooks, or over source_df. Options are those of run_table_job."""
    job = table_job("orders", orders_rules())

    def read_source() -> DataFrame:
        if source_df is not None:
            return source_df
        path = source_path or settings.storage.incoming_path
        wanted = is_orders_workbook(F.col("file_name"))
        return read_workbooks(spark, path, job.schema, wanted=wanted)

    return run_table_job(spark, job, settings, read_source, **options)


def run_order_items(
    spark: SparkSession,
    settings: RunSettings,
    *,
    source_df: DataFrame | None = None,
    source_path: str | None = None,
    orders_df: DataFrame | None = None,
    orders_path: str | None = None,
    dense_keys: bool = False,
    **options,
) -> dict[str, int]:
    """Order items job over workbooks, or over source_df, checked against orders.

    Orders come from orders_df, else from the orders table, which is empty before any order has
    been loaded. dense_keys has their ids taken as bitmaps, see ReferentialIntegrityRule. Options are
    those of run_table_job.
    """
    if orders_df is None:
        orders_path = orders_path or settings.storage.table_path("orders")
        create_table_if_not_exists(spark, ORDERS_SCHEMA, orders_path, PARTITION_COLS["orders"])
        orders_df = read_table(spark, orders_path)
    job = table_job("order_items", order_items_rules(orders_df, dense_keys=dense_keys))

    def read_source() -> DataFrame:
        if source_df is not None:
            return source_df
        path = source_path or settings.storage.incoming_path
        wanted = is_items_workbook(F.col("file_name"))
        return read_workbooks(spark, path, job.schema, wanted=wanted)

    return run_table_job(spark, job, settings, read_source, **options)
