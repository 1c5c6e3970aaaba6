"""Five-minute metrics and alarms over run events, batch or stream.

Events have ts, level, event, job_name, environment and records_rejected. The same functions take
a static frame or a stream; a stream needs ``late``, how long a window waits for late events.
Sums are combined map-side, so one busy job is no hot group. Periods without a counted event are
absent: missing data raises no alarm.
"""

from __future__ import annotations

from datetime import date, datetime

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkgate.sources import hadoop
from sparkgate.sources.staging import StagingArea

# Metric period and alarm thresholds.
PERIOD = "5 minutes"
ERROR_THRESHOLD = 1
REJECT_THRESHOLD = 100


def _per_period(
    events: DataFrame, wanted: Column, amount: Column, name: str, late: str | None, quiet: bool
) -> DataFrame:
    """Sum of amount over the wanted events, per period, job and environment.

    With quiet, periods that saw events but no wanted one are there as well, with null.
    """
    if late is None:
        events = events if quiet else events.filter(wanted)
    else:
        # Not filtered: every event moves the watermark on, or a quiet job's last window, whose
        # alarm matters most, would stay open until the next error.
        events = events.withWatermark("ts", late)
    sums = events.groupBy(F.window("ts", PERIOD), "job_name", "environment").agg(
        F.sum(F.when(wanted, amount)).alias(name)
    )
    return (
        sums.filter(F.lit(True) if quiet else F.col(name).isNotNull())
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "job_name",
            "environment",
            name,
        )
    )


def error_counts(events: DataFrame, late: str | None = None, *, quiet: bool = False) -> DataFrame:
    """ERROR events per period, job and environment."""
    return _per_period(events, F.col("level") == "ERROR", F.lit(1), "errors", late, quiet)


def error_alarms(
    events: DataFrame, late: str | None = None, threshold: int = ERROR_THRESHOLD
) -> DataFrame:
    """Periods with at least threshold errors."""
    return error_counts(events, late).filter(F.col("errors") >= threshold)


def reject_sums(events: DataFrame, late: str | None = None, *, quiet: bool = False) -> DataFrame:
    """Rejected records per period, job and environment."""
    rejected = F.col("records_rejected")
    return _per_period(events, rejected > 0, rejected, "records_rejected", late, quiet)


def reject_alarms(
    events: DataFrame, late: str | None = None, threshold: int = REJECT_THRESHOLD
) -> DataFrame:
    """Periods with more than threshold rejected records."""
    return reject_sums(events, late).filter(F.col("records_rejected") > threshold)


def completions(events: DataFrame, late: str | None = None) -> DataFrame:
    """Finished jobs per period, job and environment."""
    return _per_period(events, F.col("event") == "JOB_COMPLETE", F.lit(1), "completions", late, False)


def transitions(windows: DataFrame, breaching: Column) -> DataFrame:
    """When alarms turned on and off: changed_at, job_name, environment and state, ALARM or OK.

    windows holds all periods that saw events, quiet ones too, see error_counts; breaching tells
    the periods above the threshold. A period is judged at its end. An alarm turns on with the
    first breaching period, and off with the first that does not breach, whether it saw events or
    not: missing data is fine. It is still on where no later event has come, from any job, than
    the end of that period. Periods that follow each other without a gap are one alarm.
    """
    latest = windows.agg(F.max("window_start")).scalar()
    own = Window.partitionBy("job_name", "environment").orderBy("window_start")
    before, after = F.lag("window_end").over(own), F.lead("window_start").over(own)
    length = F.expr(f"INTERVAL {PERIOD}")
    quiet_at = F.col("window_end") + length
    judged = windows.filter(F.coalesce(breaching, F.lit(False))).select(
        "job_name", "environment", "window_end", quiet_at.alias("quiet_at"),
        F.coalesce(before < F.col("window_start"), F.lit(True)).alias("starts"),
        F.coalesce(after > F.col("window_end"), F.lit(True)).alias("ends"),
    ).withColumn("latest", latest)
    on = F.when(F.col("starts"), F.struct(F.col("window_end").alias("changed_at"), F.lit("ALARM").alias("state")))
    off = F.when(
        F.col("ends") & (F.col("quiet_at") <= F.col("latest")),
        F.struct(F.col("quiet_at").alias("changed_at"), F.lit("OK").alias("state")),
    )
    changes = judged.select("job_name", "environment", F.explode(F.array_compact(F.array(on, off))).alias("change"))
    return changes.select("change.changed_at", "job_name", "environment", "change.state")


def error_transitions(windows: DataFrame, threshold: int = ERROR_THRESHOLD) -> DataFrame:
    """transitions() of the error alarm, over error_counts with quiet periods."""
    return transitions(windows, F.col("errors") >= threshold)


def reject_transitions(windows: DataFrame, threshold: int = REJECT_THRESHOLD) -> DataFrame:
    """transitions() of the alarm on rejects, over reject_sums with quiet periods."""
    return transitions(windows, F.col("records_rejected") > threshold)


WINDOW_KEYS = ["window_start", "window_end", "job_name", "environment"]
_BATCH_COL, _DAY_COL = "batch_id", "day"


def start_alarm_table(
    windows: DataFrame, path: str, checkpoint_path: str, *, compact_every: int = 0, open_for: str = "1 day"
) -> StreamingQuery:
    """Keep the windows of a stream at path, each as soon as an event has changed it.

    An alarm so does not wait for later events to close its window, and the last windows come out
    as well. Every batch writes a folder of its own, which a replay of the batch replaces; readers
    take a window from the last batch that has it, see read_alarm_table. With compact_every, every
    so many batches the windows that ended longer than open_for before the last one are put
    together, see compact_alarm_table.
    """
    schema = windows.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batches/{_BATCH_COL}={batch_id}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            spark = batch.sparkSession
            last = read_alarm_table(spark, path, schema).agg(
                F.max("window_end") - F.expr(f"INTERVAL {open_for}")
            ).first()[0]
            if last is not None:
                compact_alarm_table(spark, path, schema, last)

    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def _states(spark: SparkSession, path: str, schema: T.StructType, folder: str, extra: list) -> DataFrame:
    """All stored states of windows in one of the table's folders, with the batch of each."""
    stored = T.StructType([*schema.fields, *extra])
    if not hadoop.exists(spark, f"{path}/{folder}"):
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).option("basePath", f"{path}/{folder}").parquet(f"{path}/{folder}")


def _latest(states: DataFrame, schema: T.StructType) -> DataFrame:
    """Of each window, job and environment the state of the last batch; combined map-side."""
    values = [name for name in schema.fieldNames() if name not in WINDOW_KEYS]
    last = F.max_by(F.struct(*values, _BATCH_COL), F.col(_BATCH_COL)).alias("latest")
    return states.groupBy(*WINDOW_KEYS).agg(last).select(*WINDOW_KEYS, "latest.*")


def _batch_states(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _states(spark, path, schema, "batches", [T.StructField(_BATCH_COL, T.LongType())])


def _closed_states(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    extra = [T.StructField(_BATCH_COL, T.LongType()), T.StructField(_DAY_COL, T.DateType())]
    return _states(spark, path, schema, "closed", extra)


def read_alarm_table(
    spark: SparkSession, path: str, schema: T.StructType, *, since: date | None = None
) -> DataFrame:
    """The latest state of each window, job and environment; of those that start on a day from since on.

    Days before since are not read where they have been put together.
    """
    states = _batch_states(spark, path, schema)
    closed = _closed_states(spark, path, schema)
    if since is not None:
        states = states.filter(F.col("window_start").cast("date") >= F.lit(since))
        closed = closed.filter(F.col(_DAY_COL) >= F.lit(since))
    found = _latest(states.unionByName(closed.drop(_DAY_COL)), schema)
    return found.select(*schema.fieldNames())


def compact_alarm_table(spark: SparkSession, path: str, schema: T.StructType, closed_before: datetime) -> int:
    """Put the states of batches whose windows all ended by then together in a folder per day.

    Returns how many batch folders went. Only the days concerned are written, from a staged copy,
    and batches are removed after that: a run that breaks off leaves states twice, of which readers
    take one. A window that a later batch changes all the same has its state in that batch.
    """
    batches = _batch_states(spark, path, schema)
    done = batches.groupBy(_BATCH_COL).agg(F.max("window_end").alias("last")).filter(F.col("last") <= F.lit(closed_before))
    numbers = [row[_BATCH_COL] for row in done.select(_BATCH_COL).collect()]
    if not numbers:
        return 0
    with StagingArea(spark, "alarms") as staging:
        ready = batches.filter(F.col(_BATCH_COL).isin(numbers)).withColumn(_DAY_COL, F.col("window_start").cast("date"))
        ready = staging.write(ready, "ready")
        days = ready.select(_DAY_COL).distinct()
        closed = _closed_states(spark, path, schema).join(F.broadcast(days), _DAY_COL, "left_semi")
        states = _latest(ready.drop(_DAY_COL).unionByName(closed.drop(_DAY_COL)), schema)
        states = staging.write(states.withColumn(_DAY_COL, F.col("window_start").cast("date")), "states")
        states.hint("rebalance", _DAY_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            _DAY_COL
        ).parquet(f"{path}/closed")
    for number in numbers:
        hadoop.remove(spark, f"{path}/batches/{_BATCH_COL}={number}")
    return len(numbers)
