"""Physical plans: what is pushed down, what shuffles, and how hot keys are split."""

from __future__ import annotations

import contextlib
import random
import re
from datetime import date, datetime

import pyspark.sql.functions as F
import pytest

from sparkgate.operators.ladder import label_rows, rejected_rows
from sparkgate.operators.merge import merge_rows
from sparkgate.operators.rules import (
    NotNullRule,
    ReferentialIntegrityRule,
    UniqueKeyRule,
    ValidationRule,
)
from sparkgate.plans import audits
from sparkgate.streaming import alarms


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    """The adaptive plan after it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.toString()


@pytest.fixture
def items(spark, tmp_path):
    """Items a third of which share one order, and a sixth of which have none."""
    rows = spark.range(60_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 != 1, F.col("id")).alias("order_id"),
        F.repeat(F.lit("text"), 20).alias("note"),
    )
    rows.write.parquet(str(tmp_path / "items"))
    return spark.read.parquet(str(tmp_path / "items"))


def test_a_hot_foreign_key_is_split_and_null_keys_are_spread(spark, items, tmp_path):
    spark.range(50_000).write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    rules = [NotNullRule("order_id"), ReferentialIntegrityRule("order_id", orders, "id")]
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        labelled = label_rows(items, rules, look_ahead=False)
        assert "SortMergeJoin(skew=true)" in final_plan_of(labelled)
        # Rows without an order do not gather in one partition of the join.
        per_partition = (
            labelled.filter("order_id is null").groupBy(F.spark_partition_id()).count()
        )
        assert per_partition.count() > 4
        found = labelled.groupBy("__rule__").count().collect()
    expected = {None: 0, 0: 0, 1: 0}
    for n in range(60_000):
        order = 7 if n % 3 == 0 else n if n % 6 != 1 else None
        expected[0 if order is None else None if order < 50_000 else 1] += 1
    assert {r["__rule__"]: r["count"] for r in found} == expected


def test_stateless_rules_do_not_shuffle(items):
    plan = plan_of(rejected_rows(label_rows(items, [NotNullRule("order_id")]), [NotNullRule("order_id")]))
    assert "Exchange" not in plan
    assert "IsNull(order_id)" in plan or "isnull(order_id" in plan


def test_rows_with_sound_keys_stay_where_they_are(spark, items):
    orders = spark.range(70_000).withColumnRenamed("id", "order_id")
    rules = [NotNullRule("order_id"), UniqueKeyRule(["id"]),
             ReferentialIntegrityRule("order_id", orders, "order_id")]
    plan = plan_of(label_rows(items, rules, look_ahead=True))
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_only_rows_of_repeated_keys_are_shuffled(spark, items):
    rows = items.unionByName(items.filter("id % 1000 = 0"))
    labelled = label_rows(rows, [UniqueKeyRule(["id"])], look_ahead=True)
    calm, contested = plan_of(labelled).split("\n   +- ", 1)
    assert "Exchange hashpartitioning" not in calm and "Window" not in calm
    # The few rows left of the join with the repeated keys are what the window shuffles.
    assert contested.count("Exchange hashpartitioning") == 1
    assert contested.index("Exchange hashpartitioning") < contested.index("Inner, BuildRight")
    assert labelled.filter("__rule__ = 0").count() == 60


def test_unique_rule_that_cannot_broadcast_shuffles_once(items):
    rows = items.unionByName(items)
    rules = [UniqueKeyRule(["id"])]
    once = label_rows(rows, rules, look_ahead=True, broadcast_bytes=0)
    assert plan_of(once).count("Exchange hashpartitioning") == 1
    twice = label_rows(rows, rules, look_ahead=True, broadcast_bytes=0, hot_rows=1)
    assert plan_of(twice).count("Exchange hashpartitioning") == 2


def test_orphans_are_found_without_shuffling_rows(spark, items):
    orders = spark.range(59_000).withColumnRenamed("id", "order_id")
    rules = [NotNullRule("order_id"), ReferentialIntegrityRule("order_id", orders, "order_id")]
    labelled = label_rows(items, rules, look_ahead=True)
    plan = plan_of(labelled)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert labelled.filter("__rule__ = 1").count() == items.filter("order_id >= 59000").count()


def test_by_default_nothing_runs_ahead(spark, items):
    tracker = spark.sparkContext._jsc.sc().dagScheduler()
    before = tracker.nextJobId()
    label_rows(items, [UniqueKeyRule(["id"])])
    assert tracker.nextJobId() == before


def test_failed_rows_do_not_gather_in_the_window(spark, items):
    rules = [NotNullRule("order_id"), UniqueKeyRule(["order_id"])]
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        labelled = label_rows(items, rules, look_ahead=False)
        sizes = labelled.filter("order_id is null").groupBy(F.spark_partition_id()).count()
        assert sizes.count() > 4


def test_merge_prunes_columns_of_the_source_keys(spark, items, tmp_path):
    plan = plan_of(merge_rows(items, items.limit(10).withColumn("note", F.lit("new")), ["id"]))
    assert re.search("LeftAnti", plan)


def test_alarm_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(10).selectExpr(
        "timestamp_seconds(id) as ts", "'ERROR' as level", "'E' as event", "'j' as job_name",
        "'dev' as environment", "id as records_rejected", "'long' as message",
    ).write.parquet(path)
    events = spark.read.parquet(path)
    plan = plan_of(alarms.reject_alarms(events))
    assert "GreaterThan(records_rejected,0)" in plan
    assert "message" not in plan and "level" not in plan


def test_orphan_audit_reads_keys_only(items):
    plan = plan_of(audits.orphaned_order_items(items, items.select(F.col("id").alias("order_id"))))
    assert "note" not in plan


def test_a_hot_key_is_ranked_in_many_tasks_by_default(spark):
    rows = spark.range(0, 3_000_000, 1, 8).select(F.lit(1).alias("key"), "id")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        labelled = label_rows(rows, [UniqueKeyRule(["key"])])
        first_window = F.spark_partition_id().alias("task")
        counts = [r["count"] for r in labelled.filter("__rule__ = 0").groupBy(first_window).count().collect()]
    assert sum(counts) == 2_999_999 and max(counts) < 1_500_000


def test_survivors_are_unique_though_the_source_differs_each_time(spark):
    @F.udf("int")
    def drawn(n):
        import random

        return random.randrange(2000)

    rows = spark.range(0, 2000, 1, 4).select(drawn.asNondeterministic()("id").alias("key"))
    left = label_rows(rows, [UniqueKeyRule(["key"])]).filter("__rule__ IS NULL").select("key").collect()
    assert len(left) == len(set(left)) > 500


def test_splitting_rules_do_not_repeat_what_came_before(spark):
    class Under(ValidationRule):
        def __init__(self, limit):
            self.limit = limit

        rule_name = "under:id"

        def validate(self, df):
            good = F.col("id") < self.limit
            return df.filter(good), df.filter(~good).withColumn("__error_reason__", F.lit("over"))

    rules = [UniqueKeyRule(["id"]), *[Under(n) for n in (90, 80, 70, 60)]]
    labelled = label_rows(spark.range(100).union(spark.range(10)), rules)
    assert "Window" not in plan_of(labelled)
    counts = {r["__rule__"]: r["count"] for r in labelled.groupBy("__rule__").count().collect()}
    assert counts == {None: 60, 0: 10, 1: 10, 2: 10, 3: 10, 4: 10}


def test_counting_reads_only_what_decides(spark, tmp_path):
    from sparkgate.operators.ladder import narrowed_to_count
    from sparkgate.operators.validation import validation_summary
    from sparkgate.plans.rule_sets import orders_rules
    from sparkgate.schemas import ORDERS_SCHEMA, raw_schema

    rng = random.Random(2)
    rows = [
        (rng.randrange(4), rng.choice([None, *range(30)]), rng.choice([None, 1, 2]),
         datetime(2025, 1, rng.randrange(1, 4)), rng.choice([-1.0, 0.0, 5.0]), date(2025, 1, rng.randrange(1, 28)))
        for _ in range(400)
    ]
    spark.createDataFrame(rows, raw_schema(ORDERS_SCHEMA)).write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders").withColumn("note", F.lit("x"))
    rules = orders_rules()
    narrow = narrowed_to_count(orders, rules)
    assert narrow.columns == ["order_num", "order_id", "user_id", "order_timestamp", "total_amount"]
    summary = validation_summary(label_rows(narrow, rules))
    assert "date" not in plan_of(summary).split("ReadSchema: ")[1].split("\n")[0]

    def counts(frame, applied=rules):
        return sorted(map(tuple, label_rows(frame, applied).groupBy("__rule__").count().collect()), key=str)

    assert counts(narrow) == counts(orders)
    # What comes before the last column that a later rule reads decides, what comes after does not.
    unique = [UniqueKeyRule(["order_id"])]
    assert narrowed_to_count(orders, unique).columns == ["order_id"]
    by_user = [UniqueKeyRule(["order_id"], order_by=["date"]), NotNullRule("user_id")]
    assert narrowed_to_count(orders, by_user).columns == ["order_num", "order_id", "user_id", "date"]
    assert counts(narrowed_to_count(orders, by_user), by_user) == counts(orders, by_user)
