"""Whole jobs on local folders: counts, gate, reruns, and the run over a landing folder."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date, datetime

import pyspark.sql.functions as F
import pytest

from sparkgate.errors import SchemaError, StorageWriteError, ValidationError
from sparkgate.plans.full_run import archive_file, run_all
from sparkgate.plans.jobs import EMPTY_SUMMARY, run_order_items, run_orders, run_products
from sparkgate.queries.workbook_copies import workbook_bytes
from sparkgate.schemas import ORDER_ITEMS_SCHEMA, ORDERS_SCHEMA, PRODUCTS_SCHEMA, raw_schema
from sparkgate.settings import settings_from_args
from sparkgate.sources.quarantine import read_quarantine
from sparkgate.sources.run_metrics import read_metrics, read_run_events
from sparkgate.sources.staging import staging_root
from sparkgate.sources.tables import get_table_version, read_table, table_exists

TS = datetime(2025, 4, 1, 8, 15)
DAY = date(2025, 4, 1)


@pytest.fixture
def settings(storage_args):
    return settings_from_args(storage_args)


def orders_of(spark, rows):
    """Orders from (order_id, amount, day); other columns are sound."""
    full = [(n, key, 11, TS, amount, day) for n, (key, amount, day) in enumerate(rows)]
    return spark.createDataFrame(full, raw_schema(ORDERS_SCHEMA))


def items_of(spark, rows):
    full = [(key, order, 11, None, 1, 1, flag, TS, DAY) for key, order, flag in rows]
    return spark.createDataFrame(full, raw_schema(ORDER_ITEMS_SCHEMA))


def test_orders_job_end_to_end(spark, settings):
    path = settings.storage.table_path("orders")
    staged_before = os.listdir(f"{staging_root(spark)}/sparkgate") if os.path.isdir(
        f"{staging_root(spark)}/sparkgate") else []
    source = orders_of(
        spark,
        [(101, 5.0, DAY), (102, 1.0, date(2025, 4, 2)), (101, 9.0, DAY), (None, 2.0, DAY),
         (103, 0.0, DAY), (104, -1.0, DAY)],
    )
    summary = run_orders(spark, settings, source_df=source)
    assert summary == {"total": 6, "valid": 2, "rejected": 4, "inserted": 2, "updated": 0}
    again = run_orders(spark, settings, source_df=source)
    assert again == {"total": 6, "valid": 2, "rejected": 4, "inserted": 0, "updated": 2}
    assert sorted((r.order_id, r.total_amount) for r in read_table(spark, path).collect()) == [
        (101, 5.0), (102, 1.0)]
    assert get_table_version(spark, path) == 2
    assert {n for n in os.listdir(f"{path}/data") if "=" in n} == {"date=2025-04-01", "date=2025-04-02"}

    rejects = read_quarantine(spark, settings.storage.quarantine_base_path, "orders")
    reasons = {r["__error_reason__"]: r["count"] for r in rejects.groupBy("__error_reason__").count().collect()}
    assert reasons == {
        "null value in required column 'order_id'": 2,
        "duplicate key on columns: ['order_id']": 2,
        "'total_amount' must be > 0": 4,
    }
    metrics = read_metrics(spark, settings.storage.metrics_path)
    assert metrics.count() == 2
    assert metrics.agg(F.sum("rows_inserted"), F.sum("rows_updated")).first() == (2, 2)
    events = read_run_events(spark, settings.storage.events_path).collect()
    assert {(e.level, e.event, e.records_rejected) for e in events} == {("INFO", "JOB_COMPLETE", 4)}
    assert os.listdir(f"{staging_root(spark)}/sparkgate") == staged_before


def test_an_updated_amount_and_a_moved_day(spark, settings):
    run_orders(spark, settings, source_df=orders_of(spark, [(1, 5.0, DAY), (2, 6.0, DAY)]))
    summary = run_orders(
        spark, settings, source_df=orders_of(spark, [(1, 999.99, date(2025, 4, 30))]))
    assert (summary["inserted"], summary["updated"]) == (0, 1)
    table = read_table(spark, settings.storage.table_path("orders"))
    assert {(r.order_id, r.total_amount, r.date.day) for r in table.collect()} == {
        (1, 999.99, 30), (2, 6.0, 1)}


def test_gate_quarantines_then_stops_before_the_table(spark, settings):
    strict = replace(settings, max_quarantine_ratio=0.5)
    half_bad = orders_of(spark, [(1, 1.0, DAY), (2, 0.0, DAY)])
    assert run_orders(spark, strict, source_df=half_bad)["rejected"] == 1
    mostly_bad = orders_of(spark, [(3, 1.0, DAY), (4, 0.0, DAY), (5, -1.0, DAY)])
    with pytest.raises(ValidationError) as caught:
        run_orders(spark, strict, source_df=mostly_bad)
    assert caught.value.failure_ratio == pytest.approx(2 / 3)
    storage = settings.storage
    assert read_quarantine(spark, storage.quarantine_base_path, "orders").count() == 3
    assert get_table_version(spark, storage.table_path("orders")) == 1
    assert read_metrics(spark, storage.metrics_path).count() == 1
    failed = read_run_events(spark, storage.events_path).filter("level = 'ERROR'").collect()
    assert [e.event for e in failed] == ["JOB_FAILED"]


def test_all_rejected_passes_the_default_limit(spark, settings):
    summary = run_orders(spark, settings, source_df=orders_of(spark, [(1, -5.0, DAY)]))
    assert summary == {"total": 1, "valid": 0, "rejected": 1, "inserted": 0, "updated": 0}


def test_empty_input_touches_nothing(spark, settings):
    assert run_orders(spark, settings, source_df=orders_of(spark, [])) == EMPTY_SUMMARY
    assert not table_exists(spark, settings.storage.table_path("orders"))
    assert not os.path.exists(settings.storage.metrics_path)


def test_null_outside_the_rules_is_a_schema_error(spark, settings):
    with pytest.raises(SchemaError, match="'date'"):
        run_orders(spark, settings, source_df=orders_of(spark, [(1, 5.0, None)]))
    assert read_table(spark, settings.storage.table_path("orders")).count() == 0


def test_order_items_against_orders(spark, settings):
    orders = orders_of(spark, [(101, 5.0, DAY), (102, 5.0, DAY)])
    items = items_of(
        spark,
        [(1, 101, 0), (2, 102, 1), (3, 999, 0), (4, 101, 2), (None, 101, 0), (2, 101, 0)],
    )
    summary = run_order_items(spark, settings, source_df=items, orders_df=orders)
    assert summary == {"total": 6, "valid": 2, "rejected": 4, "inserted": 2, "updated": 0}
    table = read_table(spark, settings.storage.table_path("order_items"))
    assert table.columns == ORDER_ITEMS_SCHEMA.fieldNames()
    assert {(r.id, r.days_since_prior_order) for r in table.collect()} == {(1, None), (2, None)}


def test_order_items_read_the_orders_table(spark, settings):
    run_orders(spark, settings, source_df=orders_of(spark, [(101, 5.0, DAY)]))
    items = items_of(spark, [(1, 101, 0), (2, 102, 1)])
    assert run_order_items(spark, settings, source_df=items)["rejected"] == 1
    assert run_order_items(spark, settings, source_df=items, dense_keys=True)["rejected"] == 1


def test_products_from_csv(spark, settings):
    incoming = settings.storage.incoming_path
    os.makedirs(incoming)
    lines = [",".join(PRODUCTS_SCHEMA.fieldNames()), "1,4,produce,Pears", "1,4,produce,Plums",
             ",16,dairy,Milk", "4,21,,Bread", "5,7,drinks,", "6,13,pantry,Oil"]
    with open(f"{incoming}/products.csv", "w") as out:
        out.write("\n".join(lines) + "\n")
    summary = run_products(spark, settings)
    assert summary == {"total": 6, "valid": 2, "rejected": 4, "inserted": 2, "updated": 0}
    table = read_table(spark, settings.storage.table_path("products"))
    assert sorted((r.product_id, r.product_name) for r in table.collect()) == [
        (1, "Pears"), (6, "Oil")]


def test_full_run_over_a_landing_folder(spark, settings):
    settings = replace(settings, database="full_run_test")
    incoming = settings.storage.incoming_path.rstrip("/")
    os.makedirs(incoming)
    with open(f"{incoming}/products.csv", "w") as out:
        out.write(",".join(PRODUCTS_SCHEMA.fieldNames()) + "\n1,4,produce,Pears\n")
    books = {
        "orders_apr.xlsx": (ORDERS_SCHEMA, [(1, 101, 11, TS, 5.5, DAY), (2, 102, 11, TS, 0, DAY)]),
        "order_items_apr.xlsx": (
            ORDER_ITEMS_SCHEMA,
            [(1, 101, 11, None, 1, 1, 0, TS, DAY), (2, 102, 11, 3, 1, 1, 0, TS, DAY)],
        ),
    }
    for name, (schema, rows) in books.items():
        with open(f"{incoming}/{name}", "wb") as out:
            out.write(workbook_bytes(schema.fieldNames(), rows))

    trigger = f"{incoming}/products.csv"
    summary = run_all(spark, settings, trigger_file=trigger)
    assert {t: (s["total"], s["rejected"], s["inserted"]) for t, s in summary.items()} == {
        "products": (1, 0, 1), "orders": (2, 1, 1), "order_items": (2, 1, 1)}
    joined = spark.sql(
        "SELECT o.total_amount, p.product_name FROM full_run_test.order_items i "
        "JOIN full_run_test.orders o USING (order_id) "
        "JOIN full_run_test.products p USING (product_id)"
    )
    assert [tuple(r) for r in joined.collect()] == [(5.5, "Pears")]
    assert not os.path.exists(trigger)
    archived = [f for _, _, files in os.walk(settings.storage.archive_path) for f in files]
    assert "products.csv" in archived
    with pytest.raises(StorageWriteError):
        archive_file(spark, trigger, settings.storage.archive_path)
