"""Upserts: as pure functions, and into versioned tables."""

from __future__ import annotations

import random

import pyspark.sql.functions as F
import pytest
from pyspark.sql import types as T

from sparkgate.errors import DuplicateKeyError, NullKeyError, SchemaError, TableMergeError
from sparkgate.operators.merge import merge_actions, merge_counts, merge_rows, touched_partitions
from sparkgate.sources import hadoop, tables
from sparkgate.sources.catalog import follow_schema, register_table, schema_drift
from sparkgate.sources.tables import (
    MergeResult,
    create_table_if_not_exists,
    get_table_version,
    load_table,
    merge_history,
    merge_into_catalog_table,
    read_table,
    table_exists,
    write_table_merge,
)

SCHEMA = T.StructType(
    [
        T.StructField("k", T.IntegerType(), False),
        T.StructField("v", T.StringType()),
        T.StructField("day", T.DateType()),
    ]
)
DDL = "k int, v string, day string"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL).withColumn("day", F.col("day").cast("date"))


def rows_of(df):
    return {r.k: (r.v, str(r.day)) for r in df.collect()}


def test_merge_result_total():
    assert MergeResult(3, 2, 10).total_affected == 15


def test_pure_merge_and_its_counts(spark):
    old = frame(spark, [(1, "a", "2025-01-01"), (2, "b", "2025-01-01"), (None, "n", None)])
    new = frame(spark, [(2, None, "2025-01-02"), (3, "c", "2025-01-03"), (None, "m", None)])
    merged = merge_rows(old, new, ["k"])
    assert sorted((r.k or 0, r.v or "") for r in merged.collect()) == [
        (0, "m"), (0, "n"), (1, "a"), (2, ""), (3, "c")]
    actions = {(r.k, r.v): r["__action__"] for r in merge_actions(old, new, ["k"]).collect()}
    assert actions == {
        (1, "a"): "unchanged", (None, "n"): "unchanged",
        (2, None): "update", (3, "c"): "insert", (None, "m"): "insert"}
    assert tuple(merge_counts(old, new, ["k"]).first()) == (2, 1, 2)
    touched = touched_partitions(old, new, ["k"], ["day"]).collect()
    assert [str(r.day) for r in touched] == ["2025-01-01"]


def test_create_is_idempotent_and_versions_grow(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    create_table_if_not_exists(spark, SCHEMA, path, ["day"])
    create_table_if_not_exists(spark, SCHEMA, path, ["day"])
    assert table_exists(spark, path)
    assert get_table_version(spark, path) == 0
    assert read_table(spark, path).count() == 0
    assert read_table(spark, path).columns == ["k", "v", "day"]
    batch = frame(spark, [(1, "a", "2025-01-01"), (2, "b", "2025-01-02")])
    assert write_table_merge(spark, batch, path, ["k"]) == MergeResult(2, 0, 0)
    assert write_table_merge(spark, batch, path, ["k"]) == MergeResult(0, 2, 0)
    assert write_table_merge(spark, batch.limit(0), path, ["k"]) == MergeResult(0, 0, 2)
    assert get_table_version(spark, path) == 3
    assert read_table(spark, path).count() == 2


def days_of(spark, path):
    """Partition folders that hold rows, with their files."""
    rows = spark.read.parquet(f"{path}/data").select("day", F.col("_metadata.file_name").alias("file")).distinct()
    found = {}
    for row in rows.collect():
        found.setdefault(str(row["day"]), set()).add(row["file"])
    return found


def test_a_row_moves_between_partitions_and_empties_its_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, ["day"], keys=["k"], history=True)
    write_table_merge(spark, frame(spark, [(1, "a", "2025-01-01"), (2, "b", "2025-01-02")]), path, ["k"])
    result = write_table_merge(spark, frame(spark, [(1, "a2", "2025-01-09")]), path, ["k"])
    assert result == MergeResult(0, 1, 1)
    assert rows_of(read_table(spark, path)) == {1: ("a2", "2025-01-09"), 2: ("b", "2025-01-02")}
    assert set(days_of(spark, path)) == {"2025-01-02", "2025-01-09"}
    # The earlier versions are still what they were.
    assert rows_of(read_table(spark, path, version=1)) == {1: ("a", "2025-01-01"), 2: ("b", "2025-01-02")}
    assert rows_of(read_table(spark, path, version=0)) == {}


def test_only_partitions_that_are_touched_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, ["day"])
    write_table_merge(spark, frame(spark, [(1, "a", "2025-01-01"), (2, "b", "2025-01-02")]), path, ["k"])
    before = days_of(spark, path)
    # New keys are added beside what is there.
    write_table_merge(spark, frame(spark, [(3, "c", "2025-01-01")]), path, ["k"])
    after = days_of(spark, path)
    assert before["2025-01-01"] < after["2025-01-01"] and before["2025-01-02"] == after["2025-01-02"]
    write_table_merge(spark, frame(spark, [(2, "b2", "2025-01-02")]), path, ["k"])
    last = days_of(spark, path)
    assert last["2025-01-01"] == after["2025-01-01"] and not last["2025-01-02"] & after["2025-01-02"]


@pytest.mark.parametrize("partition_cols", [[], ["day"], ["day", "v"]])
@pytest.mark.parametrize("buckets", [0, 3])
def test_every_version_can_be_read_again(spark, tmp_path, partition_cols, buckets):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, partition_cols, keys=["k"], buckets=buckets, history=True)
    draw = random.Random(buckets)
    model, versions = {}, [{}]
    for _ in range(3):
        batch = {draw.randrange(15): (draw.choice("xy"), f"2025-01-0{draw.randrange(1, 4)}") for _ in range(6)}
        model.update(batch)
        versions.append(dict(model))
        write_table_merge(spark, frame(spark, [(k, *rest) for k, rest in batch.items()]), path, ["k"])
    for version, rows in enumerate(versions):
        assert rows_of(read_table(spark, path, version=version)) == rows
    with pytest.raises(TableMergeError):
        read_table(spark, path, version=9)
    with pytest.raises(NullKeyError):
        write_table_merge(spark, frame(spark, [(None, "a", None)]), path, ["k"])


@pytest.mark.parametrize("partition_cols", [[], ["day"], ["day", "v"]])
def test_merges_equal_a_dictionary(spark, tmp_path, partition_cols):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, partition_cols)
    draw = random.Random(len(partition_cols))
    model = {}
    for _ in range(3):
        batch = {
            draw.randrange(25): (draw.choice(["x y", "a/b=c", "%", "é"]),
                                 f"2025-01-0{draw.randrange(1, 4)}")
            for _ in range(12)
        }
        known = set(model) & set(batch)
        size = len(model)
        model.update(batch)
        source = frame(spark, [(k, *rest) for k, rest in batch.items()])
        assert write_table_merge(spark, source, path, ["k"]) == MergeResult(
            len(batch) - len(known), len(known), size - len(known))
        assert rows_of(read_table(spark, path)) == model


def test_null_partition_values_survive(spark, tmp_path):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, ["day"])
    write_table_merge(spark, frame(spark, [(1, "a", None), (2, "b", "2025-01-01")]), path, ["k"])
    write_table_merge(spark, frame(spark, [(1, "a2", None)]), path, ["k"])
    assert rows_of(read_table(spark, path)) == {1: ("a2", "None"), 2: ("b", "2025-01-01")}


def test_merge_refusals_leave_the_table_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(TableMergeError):
        write_table_merge(spark, frame(spark, [(1, "a", None)]), path, ["k"])
    strict = T.StructType([SCHEMA["k"], T.StructField("v", T.StringType(), False), SCHEMA["day"]])
    create_table_if_not_exists(spark, strict, path, [])
    with pytest.raises(DuplicateKeyError):
        write_table_merge(spark, frame(spark, [(1, "a", None), (1, "b", None)]), path, ["k"])
    with pytest.raises(NullKeyError):
        write_table_merge(spark, frame(spark, [(None, "a", None)]), path, ["k"])
    with pytest.raises(SchemaError, match="'v'"):
        write_table_merge(spark, frame(spark, [(1, None, None)]), path, ["k"])
    assert get_table_version(spark, path) == 0


def broken_merge(monkeypatch, spark, path, rows, at):
    """A merge whose run ends at the given step."""
    def fail(*args, **options):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, at, fail)
        with pytest.raises(TableMergeError, match="lost"):
            write_table_merge(spark, frame(spark, rows), path, ["k"], batch_id="b", details={"total": 3})


@pytest.mark.parametrize("at", ["_insert", "_publish"])
def test_the_next_merge_finishes_one_that_broke_off(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, ["day"])
    write_table_merge(spark, frame(spark, [(1, "a", "2025-01-01"), (2, "b", "2025-01-01")]), path, ["k"])
    broken_merge(monkeypatch, spark, path, [(1, "a2", "2025-01-02"), (3, "c", "2025-01-01")], at)
    assert get_table_version(spark, path) == 1
    assert write_table_merge(spark, frame(spark, [(4, "d", "2025-01-02")]), path, ["k"]) == MergeResult(1, 0, 3)
    assert rows_of(read_table(spark, path)) == {
        1: ("a2", "2025-01-02"), 2: ("b", "2025-01-01"), 3: ("c", "2025-01-01"), 4: ("d", "2025-01-02")}
    told = {r.version: (r.batch_id, r.rows_inserted, r.rows_updated, r.details) for r in merge_history(spark, path).collect()}
    assert told == {1: (None, 2, 0, {}), 2: ("b", 1, 1, {"total": 3}), 3: (None, 1, 0, {})}
    assert not hadoop.exists(spark, f"{path}/pending")


def test_a_merge_that_broke_off_early_leaves_the_table_alone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, ["day"])
    write_table_merge(spark, frame(spark, [(1, "a", "2025-01-01")]), path, ["k"])
    broken_merge(monkeypatch, spark, path, [(1, "a2", "2025-01-02")], "unmatched_rows")
    assert rows_of(read_table(spark, path)) == {1: ("a", "2025-01-01")}
    assert tables.published_batch(spark, path, "b") is None
    write_table_merge(spark, frame(spark, [(1, "a3", "2025-01-02")]), path, ["k"], batch_id="b")
    assert tables.published_batch(spark, path, "b")["rows_updated"] == 1
    assert rows_of(read_table(spark, path)) == {1: ("a3", "2025-01-02")}


def test_an_append_that_broke_off_is_made_good(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, ["day"])
    write_table_merge(spark, frame(spark, [(1, "a", "2025-01-01")]), path, ["k"])
    fresh = [(2, "b", "2025-01-01"), (3, "c", "2025-01-02")]
    broken_merge(monkeypatch, spark, path, fresh, "_publish")
    assert get_table_version(spark, path) == 1
    assert write_table_merge(spark, frame(spark, fresh), path, ["k"]) == MergeResult(0, 2, 1)
    assert rows_of(read_table(spark, path)) == {1: ("a", "2025-01-01"), 2: ("b", "2025-01-01"), 3: ("c", "2025-01-02")}
    assert write_table_merge(spark, frame(spark, [(4, "d", None)]), path, ["k"]) == MergeResult(1, 0, 3)
    assert not hadoop.exists(spark, f"{path}/pending")


def test_a_table_is_found_again_without_its_catalog_entry(spark, tmp_path):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, ["day"], keys=["k"], buckets=2)
    write_table_merge(spark, frame(spark, [(1, "a", "2025-01-01"), (2, "b", None)]), path, ["k"])
    spark.sql(f"DROP TABLE {load_table(spark, path).name}")
    assert rows_of(read_table(spark, path)) == {1: ("a", "2025-01-01"), 2: ("b", "None")}
    assert write_table_merge(spark, frame(spark, [(2, "b2", None)]), path, ["k"]) == MergeResult(0, 1, 1)


def test_a_bucketed_target_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType())])
    create_table_if_not_exists(spark, schema, path, keys=["k"], buckets=4)
    write_table_merge(spark, spark.range(4000).selectExpr("id AS k", "'x' AS v"), path, ["k"])
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.shuffle.partitions", "64")
    target = load_table(session, path).rows(session)
    source = session.range(0, 8000, 2).selectExpr("id AS k", "'y' AS v")
    for joined in (
        merge_rows(target, source, ["k"]),
        tables.matched_partitions(target, source, ["k"], []),
    ):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("FileScan parquet spark_catalog")
        above = [line for line in plan[:scan].splitlines()]
        depth = len(plan[:scan].splitlines()[-1]) - len(plan[:scan].splitlines()[-1].lstrip(" :+-"))
        join = max(n for n, line in enumerate(above) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in above[join:]), (plan, depth)


def test_a_small_delivery_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("part", T.LongType())])
    create_table_if_not_exists(spark, schema, path, ["part"])
    write_table_merge(spark, spark.range(20_000).selectExpr("id AS k", "id DIV 1000 AS part"), path, ["k"])
    target = load_table(spark, path).rows(spark)
    source = spark.createDataFrame([(5,), (17,), (7_003,), (30_000,)], "k long")
    touched = tables.matched_partitions(target, source, ["k"], ["part"])
    assert {(r.part, r["__rows__"]) for r in touched.collect()} == {(0, 2), (7, 1)}
    plan = touched._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [Or(" in plan.toString()
    read = [int(x) for x in _scanned_rows(touched)]
    assert read and max(read) <= 2_000


def _scanned_rows(frame):
    """Rows that the scans of a frame's plan gave, after it ran."""
    frame.collect()
    found, left = [], [frame._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and "QueryStage" in name:
            left.append(node.plan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        left += [children.apply(n) for n in range(children.size())]
    return found


@pytest.mark.parametrize("partition_cols", [[], ["day"]])
def test_registration_follows_versions(spark, tmp_path, partition_cols):
    path = str(tmp_path / "t")
    name = f"catalog_test.t{len(partition_cols)}"
    create_table_if_not_exists(spark, SCHEMA, path, partition_cols)
    register_table(spark, name, path)
    assert spark.table(name).count() == 0
    write_table_merge(spark, frame(spark, [(1, "a", "2025-01-01"), (2, "b", None)]), path, ["k"])
    write_table_merge(spark, frame(spark, [(3, "c", "2025-01-01")]), path, ["k"])
    register_table(spark, name, path)
    found = spark.sql(f"SELECT * FROM {name} WHERE day = DATE '2025-01-01'")
    assert found.columns == ["k", "v", "day"]
    assert sorted(r.k for r in found.collect()) == [1, 3]
    assert spark.table(name).count() == 3


def test_the_catalog_follows_new_columns_and_tells_lost_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    create_table_if_not_exists(spark, SCHEMA, path, ["day"])
    assert schema_drift(spark, path).count() == 0
    write_table_merge(spark, frame(spark, [(1, "a", "2025-01-01")]), path, ["k"])
    assert schema_drift(spark, path).count() == 0
    wide = spark.createDataFrame([(7, 2.5, "x")], "k int, `a.b` double, extra string")
    wide.write.parquet(f"{path}/data/day=2025-01-03")
    spark.catalog.recoverPartitions(load_table(spark, path).name)
    changes = {tuple(r) for r in follow_schema(spark, path).collect()}
    assert changes == {("a.b", "added", "double"), ("extra", "added", "string")}
    found = {r.k: (r["a.b"], r.extra, r.v) for r in read_table(spark, path).collect()}
    assert found == {1: (None, None, "a"), 7: (2.5, "x", None)}
    assert schema_drift(spark, path).count() == 0
    result = write_table_merge(
        spark, frame(spark, [(1, "a2", "2025-01-01")]).withColumn("extra", F.lit("y")), path, ["k"])
    assert result.rows_updated == 1
    spark.read.parquet(f"{path}/data").drop("v").write.mode("overwrite").parquet(f"{tmp_path}/narrow")
    hadoop.remove(spark, f"{path}/data")
    spark.read.parquet(f"{tmp_path}/narrow").write.partitionBy("day").parquet(f"{path}/data")
    assert {tuple(r) for r in schema_drift(spark, path).collect()} == {("v", "gone", "string")}
    follow_schema(spark, path)
    assert "v" in read_table(spark, path).columns


def test_catalog_merge_is_refused_on_plain_parquet(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS catalog_test")
    spark.sql("CREATE TABLE IF NOT EXISTS catalog_test.plain (k int, v string) USING parquet")
    with pytest.raises(TableMergeError):
        merge_into_catalog_table(
            spark.createDataFrame([(1, "a")], "k int, v string"), "catalog_test.plain", ["k"])


def test_small_source_needs_no_shuffle_of_the_target(spark, tmp_path):
    old = spark.range(1000).selectExpr("id as k", "'x' as v")
    new = spark.range(5).selectExpr("id as k", "'y' as v")
    plan = merge_rows(old, new, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
