"""Run metrics and run events: one appended JSON row per run."""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.sources import hadoop

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("records_in", T.LongType()),
        T.StructField("records_valid", T.LongType()),
        T.StructField("records_rejected", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("level", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("execution_id", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("records_in", T.LongType()),
        T.StructField("records_rejected", T.LongType()),
    ]
)


def emit_job_metrics(
    spark: SparkSession,
    metrics_path: str,
    *,
    job_name: str,
    environment: str,
    records_in: int,
    records_valid: int,
    records_rejected: int,
    rows_inserted: int,
    rows_updated: int,
    duration_ms: int,
    once: str | None = None,
) -> None:
    """Append one row to the metrics table at metrics_path; with once, only the first of that name."""
    _append(
        spark,
        metrics_path,
        once and f"{job_name} {environment} {once}",
        job_name=job_name,
        environment=environment,
        records_in=records_in,
        records_valid=records_valid,
        records_rejected=records_rejected,
        rows_inserted=rows_inserted,
        rows_updated=rows_updated,
        duration_ms=duration_ms,
    )


def emit_run_event(
    spark: SparkSession,
    events_path: str,
    *,
    level: str,
    event: str,
    job_name: str,
    environment: str,
    execution_id: str,
    table: str,
    message: str = "",
    records_in: int | None = None,
    records_rejected: int | None = None,
    once: str | None = None,
) -> None:
    """Append one log event, the input of the alarm windows in streaming.alarms; with once, see above."""
    _append(
        spark,
        events_path,
        once and f"{job_name} {environment} {event} {once}",
        ts=datetime.now(timezone.utc).isoformat(),
        level=level,
        event=event,
        job_name=job_name,
        environment=environment,
        execution_id=execution_id,
        table=table,
        message=message,
        records_in=records_in,
        records_rejected=records_rejected,
    )


def _append(spark: SparkSession, path: str, once: str | None, **row: object) -> None:
    """One row is one small file, which appears whole: a stream may be reading the folder.

    A row that is to appear once has a file named after that, which is not replaced.
    """
    name = uuid.uuid4().hex if once is None else hashlib.md5(once.encode()).hexdigest()
    location = f"{path.rstrip('/')}/{name}.json"
    if once is None or not hadoop.exists(spark, location):
        hadoop.write_text(spark, location, json.dumps(row) + "\n")


def read_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(metrics_path)


def read_run_events(spark: SparkSession, events_path: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).json(events_path)
