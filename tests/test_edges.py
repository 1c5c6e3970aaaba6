"""Odd names, odd ids, odd files, and jobs started from a command line."""

from __future__ import annotations

from datetime import datetime

import pyspark.sql.functions as F

from sparkgate.operators.ladder import label_rows
from sparkgate.operators.merge import merge_rows
from sparkgate.operators.rules import (
    BooleanFlagRule,
    NotNullRule,
    PositiveAmountRule,
    ReferentialIntegrityRule,
    TimestampRangeRule,
    UniqueKeyRule,
)
from sparkgate.plans import submit
from sparkgate.sources.landing import list_files
from sparkgate.sources.quarantine import read_quarantine, write_to_quarantine
from sparkgate.sources.tables import read_table


def test_columns_with_dots_pass_all_rules(spark):
    stamp = datetime(2025, 1, 1)
    rows = spark.createDataFrame([(1, 2.0, 1, stamp)], "`a.id` int, `a.x` double, `a.f` int, `a.t` timestamp")
    known = rows.select("`a.id`")
    rules = [
        NotNullRule("a.id"), UniqueKeyRule(["a.id"]), PositiveAmountRule("a.x"), BooleanFlagRule("a.f"),
        TimestampRangeRule("a.t", stamp, stamp), ReferentialIntegrityRule("a.id", known, "a.id"),
    ]
    assert label_rows(rows, rules).filter("__rule__ IS NULL").count() == 1
    merged = merge_rows(rows, rows, ["a.id"])
    assert merged.count() == 1 and merged.columns == rows.columns


def test_quarantined_ids_stay_text(spark, tmp_path):
    base = str(tmp_path / "q")
    rejects = spark.createDataFrame([(1, "bad")], "id int, __error_reason__ string")
    assert write_to_quarantine(rejects, base, "orders", "007", "2025-01-31") == 1
    assert write_to_quarantine(rejects, base, "orders", "007", "2025-01-31") == 1
    assert write_to_quarantine(rejects.limit(0), base, "orders", "008", "2025-01-31") == 0
    found = read_quarantine(spark, base, "orders").collect()
    assert [(r.execution_id, str(r.run_date)) for r in found] == [("007", "2025-01-31")] * 2


def test_files_of_zero_bytes_are_listed(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, text in (("a.csv", "x"), ("sub/empty.csv", ""), ("b.txt", "y")):
        (tmp_path / name).write_text(text)
    found = list_files(spark, str(tmp_path), F.col("file_name").endswith(".csv")).collect()
    assert sorted((r.file_name, r.length) for r in found) == [("a.csv", 1), ("empty.csv", 0)]


def test_jobs_can_be_submitted(spark, storage_args, tmp_path):
    incoming = tmp_path / "raw" / "incoming"
    incoming.mkdir(parents=True)
    (incoming / "products.csv").write_text(
        "product_id,department_id,department,product_name\n1,1,a,x\n2,1,a,y\n2,1,a,z\n"
    )
    given = [f"--{name}={value}" for name, value in storage_args.items()]
    assert submit.main(["products", *given]) == 0
    assert read_table(spark, f"{tmp_path}/processed/tables/products/").count() == 2
    assert submit.main(["products", *given, "--MAX_QUARANTINE_RATIO", "0.1"]) == 1
    assert submit.main(["products"]) == 1
    assert submit.main(["unknown", *given]) == 1
