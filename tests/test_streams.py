"""Streams: gated loading of landing files, and alarm windows equal to their batch form."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date, datetime

import pyspark.sql.functions as F
import pytest

from sparkgate.plans import jobs
from sparkgate.plans.jobs import table_job
from sparkgate.plans.rule_sets import orders_rules, products_rules
from sparkgate.queries.workbook_copies import workbook_bytes
from sparkgate.schemas import ORDERS_SCHEMA, PRODUCTS_SCHEMA
from sparkgate.settings import settings_from_args
from sparkgate.sources.quarantine import read_quarantine
from sparkgate.sources.run_metrics import EVENTS_SCHEMA, read_metrics, read_run_events
from sparkgate.sources.tables import get_table_version, read_table
from sparkgate.streaming import alarms
from sparkgate.streaming.landing import start_table_load, stream_csv, stream_workbooks

HEADER = ",".join(PRODUCTS_SCHEMA.fieldNames())


@pytest.fixture
def settings(storage_args):
    return settings_from_args(storage_args)


def land(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join([HEADER, *lines]) + "\n")


def load(spark, settings, tmp_path, **options):
    query = start_table_load(
        spark,
        stream_csv(spark, settings.storage.incoming_path, PRODUCTS_SCHEMA, **options),
        table_job("products", products_rules()),
        settings,
        str(tmp_path / "checkpoint"),
    )
    query.awaitTermination()


def test_each_file_is_loaded_once(spark, settings, tmp_path):
    incoming, path = settings.storage.incoming_path, settings.storage.table_path("products")
    land(incoming, "a.csv", "1,1,d,Pears", "2,1,d,Figs")
    load(spark, settings, tmp_path)
    load(spark, settings, tmp_path)
    assert get_table_version(spark, path) == 1
    land(incoming, "b.csv", "2,1,d,Dates", "3,1,d,Plums", ",1,d,None")
    load(spark, settings, tmp_path)
    assert get_table_version(spark, path) == 2
    assert {r.product_id: r.product_name for r in read_table(spark, path).collect()} == {
        1: "Pears", 2: "Dates", 3: "Plums"}


def test_a_failed_gate_leaves_the_batch_for_replay(spark, settings, tmp_path):
    storage = settings.storage
    strict = replace(settings, max_quarantine_ratio=0.4)
    land(storage.incoming_path, "bad.csv", "1,1,d,Pears", ",1,d,A", ",1,d,B")
    for _ in range(2):
        with pytest.raises(Exception, match="reject ratio"):
            load(spark, strict, tmp_path)
    assert not os.path.exists(storage.table_path("products"))
    # Replays have not left the rejects twice.
    assert read_quarantine(spark, storage.quarantine_base_path, "products").count() == 2
    load(spark, settings, tmp_path)
    assert read_table(spark, storage.table_path("products")).count() == 1
    assert read_quarantine(spark, storage.quarantine_base_path, "products").count() == 2


@pytest.mark.parametrize("lost", ["emit_job_metrics", "emit_run_event"])
def test_a_batch_replayed_after_its_merge_reports_once(spark, settings, tmp_path, monkeypatch, lost):
    storage = settings.storage
    land(storage.incoming_path, "a.csv", "1,1,d,Pears", "2,1,d,Figs", ",1,d,None")
    real = getattr(jobs, lost)

    def after(*args, **options):
        if options.get("level") != "ERROR":
            real(*args, **options)
            raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, lost, after)
        with pytest.raises(Exception, match="driver lost"):
            load(spark, settings, tmp_path)
    assert get_table_version(spark, storage.table_path("products")) == 1
    load(spark, settings, tmp_path)
    assert get_table_version(spark, storage.table_path("products")) == 1
    rows = read_metrics(spark, storage.metrics_path).drop("duration_ms").collect()
    assert [tuple(r) for r in rows] == [("test-job", "test", 3, 2, 1, 2, 0)]
    done = read_run_events(spark, storage.events_path).filter("event = 'JOB_COMPLETE'")
    assert [(r.records_in, r.records_rejected) for r in done.collect()] == [(3, 1)]


def test_finished_files_go_to_the_archive(spark, settings, tmp_path):
    incoming = settings.storage.incoming_path
    archive = str(tmp_path / "archive")
    for n in range(3):
        land(incoming, f"{n}.csv", f"{n},1,d,P{n}")
        load(spark, settings, tmp_path, archive_dir=archive)
    archived = {f for _, _, files in os.walk(archive) for f in files}
    left = {f for f in os.listdir(incoming) if f.endswith(".csv")}
    assert "0.csv" in archived and not archived & left and archived | left == {
        "0.csv", "1.csv", "2.csv"}


def test_workbooks_stream_in(spark, settings, tmp_path):
    incoming = settings.storage.incoming_path
    os.makedirs(incoming)
    row = (1, 101, 11, datetime(2025, 4, 1, 8, 15), 5.0, date(2025, 4, 1))
    with open(f"{incoming}/orders.xlsx", "wb") as out:
        out.write(workbook_bytes(ORDERS_SCHEMA.fieldNames(), [row]))
    start_table_load(
        spark,
        stream_workbooks(spark, incoming, ORDERS_SCHEMA),
        lambda: table_job("orders", orders_rules()),
        settings,
        str(tmp_path / "checkpoint"),
    ).awaitTermination()
    assert [tuple(r) for r in read_table(spark, settings.storage.table_path("orders")).collect()] == [row]


def event(minute, level="INFO", name="STEP", job="a", rejected=None):
    moment = datetime(2025, 4, 1, 10, minute)
    return (moment, level, name, job, "dev", "x", "t", "", None, rejected)


EVENTS = [
    event(0, "ERROR"), event(4, "ERROR"), event(5, "ERROR", job="b"), event(6),
    event(7, name="JOB_COMPLETE", rejected=60), event(8, name="JOB_COMPLETE", rejected=41),
    event(12, name="JOB_COMPLETE", rejected=100), event(13, name="JOB_COMPLETE", rejected=0),
    event(50),
]


def values(df, column):
    return {(r.window_start.minute, r.job_name, r[column]) for r in df.collect()}


def test_alarm_windows(spark):
    events = spark.createDataFrame(EVENTS, EVENTS_SCHEMA)
    assert values(alarms.error_counts(events), "errors") == {(0, "a", 2), (5, "b", 1)}
    assert values(alarms.error_alarms(events, threshold=2), "errors") == {(0, "a", 2)}
    assert values(alarms.reject_sums(events), "records_rejected") == {(5, "a", 101), (10, "a", 100)}
    assert values(alarms.reject_alarms(events), "records_rejected") == {(5, "a", 101)}
    assert values(alarms.completions(events), "completions") == {(5, "a", 2), (10, "a", 2)}
    ends = {r.window_end - r.window_start for r in alarms.completions(events).collect()}
    assert [e.total_seconds() for e in ends] == [300]


@pytest.mark.parametrize("metric", ["error_alarms", "reject_alarms", "completions"])
def test_streamed_windows_equal_batch(spark, tmp_path, metric):
    folder = str(tmp_path / "events")
    spark.createDataFrame(EVENTS, EVENTS_SCHEMA).coalesce(1).write.json(folder)
    stream = spark.readStream.schema(EVENTS_SCHEMA).json(folder)
    windows = getattr(alarms, metric)(stream, late="10 minutes")
    windows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    batch = getattr(alarms, metric)(spark.createDataFrame(EVENTS, EVENTS_SCHEMA))
    assert values(found, found.columns[-1]) == values(batch, batch.columns[-1])
    assert found.agg(F.count("*")).first()[0] > 0


def changes(frame):
    return sorted((r.changed_at.minute, r.changed_at.hour, r.job_name, r.state) for r in frame.collect())


def test_alarms_turn_on_and_off(spark):
    events = [
        event(0, "ERROR"), event(6, "ERROR"), event(12), event(31, "ERROR"), event(58), event(59, "ERROR", job="b"),
    ]
    windows = alarms.error_counts(spark.createDataFrame(events, EVENTS_SCHEMA), quiet=True)
    assert windows.count() == 6
    # Two periods in a row are one alarm; a silent period ends one; the last is still on.
    assert changes(alarms.error_transitions(windows)) == sorted([
        (5, 10, "a", "ALARM"), (15, 10, "a", "OK"), (35, 10, "a", "ALARM"), (40, 10, "a", "OK"), (0, 11, "b", "ALARM")])
    assert changes(alarms.error_transitions(windows, threshold=2)) == []
    rejects = [event(1, rejected=101), event(2, rejected=None), event(7, rejected=100), event(20, rejected=60), event(21, rejected=60)]
    sums = alarms.reject_sums(spark.createDataFrame(rejects, EVENTS_SCHEMA), quiet=True)
    assert changes(alarms.reject_transitions(sums)) == [(5, 10, "a", "ALARM"), (10, 10, "a", "OK"), (25, 10, "a", "ALARM")]
    empty = alarms.error_counts(spark.createDataFrame([], EVENTS_SCHEMA), quiet=True)
    assert changes(alarms.error_transitions(empty)) == []


def files_below(folder):
    return sorted(f"{place}/{f}" for place, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def test_an_alarm_table_does_not_grow_with_its_batches(spark, tmp_path):
    path, schema = str(tmp_path / "alarms"), "window_start timestamp, window_end timestamp, job_name string, environment string, errors long"
    schema = spark.createDataFrame([], schema).schema

    def batch(number, *rows):
        full = [(datetime(2025, 4, d, 10, m), datetime(2025, 4, d, 10, m + 5), "a", "dev", n) for d, m, n in rows]
        spark.createDataFrame(full, schema).coalesce(1).write.parquet(f"{path}/batches/batch_id={number}")

    def found(**options):
        return sorted((r.window_start.day, r.window_start.minute, r.errors) for r in alarms.read_alarm_table(spark, path, schema, **options).collect())

    batch(0, (1, 0, 1), (1, 5, 1))
    batch(1, (1, 5, 2), (2, 0, 1))
    batch(2, (2, 0, 3), (2, 5, 1))
    expected = [(1, 0, 1), (1, 5, 2), (2, 0, 3), (2, 5, 1)]
    assert found() == expected
    assert alarms.compact_alarm_table(spark, path, schema, datetime(2025, 4, 2, 10, 6)) == 2
    assert found() == expected and sorted(os.listdir(f"{path}/batches")) == ["batch_id=2"]
    assert alarms.compact_alarm_table(spark, path, schema, datetime(2025, 4, 2, 10, 6)) == 0
    batch(3, (2, 10, 4), (3, 0, 1))
    # A window that was put away changes all the same.
    batch(4, (1, 0, 9))
    expected = [(1, 0, 9), (1, 5, 2), (2, 0, 3), (2, 5, 1), (2, 10, 4), (3, 0, 1)]
    assert found() == expected
    assert alarms.compact_alarm_table(spark, path, schema, datetime(2025, 4, 9)) == 3
    assert found() == expected and os.listdir(f"{path}/batches") == []
    assert sorted(n for n in os.listdir(f"{path}/closed") if "=" in n) == [f"day=2025-04-0{d}" for d in (1, 2, 3)]
    assert len(files_below(path)) == 3
    assert found(since=date(2025, 4, 2)) == [x for x in expected if x[0] >= 2]
    plan = alarms.read_alarm_table(spark, path, schema, since=date(2025, 4, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_stream_keeps_its_alarm_table_small(spark, tmp_path):
    folder = tmp_path / "events"
    for n in range(6):
        rows = [(datetime(2025, 4, 1 + n, 10, 7), "ERROR", "E", "a", "dev", "x", "t", "", None, None)]
        spark.createDataFrame(rows, EVENTS_SCHEMA).coalesce(1).write.mode("append").json(str(folder))
    stream = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    windows = alarms.error_counts(stream, late="10 minutes")
    path = str(tmp_path / "alarms")
    alarms.start_alarm_table(windows, path, str(tmp_path / "c"), compact_every=2).awaitTermination()
    assert alarms.read_alarm_table(spark, path, windows.schema).count() == 6
    assert len([n for n in os.listdir(f"{path}/batches") if "=" in n]) <= 3
    assert len([n for n in os.listdir(f"{path}/closed") if "=" in n]) >= 3
