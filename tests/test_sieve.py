"""Sieves: no listed key is lost, and rows that they rule out are not shuffled."""

from __future__ import annotations

import random

import pyspark.sql.functions as F
import pytest
from pyspark.sql import types as T

from sparkgate.operators.ladder import label_rows
from sparkgate.operators.merge import unmatched_rows
from sparkgate.operators.rules import NotNullRule, ReferentialIntegrityRule, UniqueKeyRule
from sparkgate.operators.sieve import can_sieve, key_sieve
from sparkgate.sources import tables
from sparkgate.sources.staging import StagingArea
from sparkgate.sources.tables import create_table_if_not_exists, read_table, write_table_merge


@pytest.fixture
def items(spark, tmp_path):
    rows = spark.range(20_000).select("id", (F.col("id") % 9_000).alias("order_id"), F.repeat(F.lit("x"), 20).alias("note"))
    rows.unionByName(rows.filter("id % 20 = 0")).write.parquet(str(tmp_path / "items"))
    return spark.read.parquet(str(tmp_path / "items"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def kept_out(spark, df) -> int:
    """Rows of the first branch of a union, which must not be shuffled."""
    calm, other = plan_of(df).split("\n   +- ", 1)
    assert "Union" in calm and "hashpartitioning" not in calm and "rangepartitioning" not in calm
    return other.count("Exchange hashpartitioning")


@pytest.mark.parametrize("count", [1, 30, 3_000])
def test_no_listed_key_is_ruled_out(spark, count):
    rng = random.Random(count)
    keys = [(rng.choice([None, rng.randrange(10**12)]), rng.choice([None, f"é{rng.randrange(99)}"])) for _ in range(count)]
    schema = "a bigint, b string"
    listed = spark.createDataFrame(keys, schema)
    others = spark.range(20_000).select((-F.col("id") - 1).alias("a"), F.lit("other").alias("b"))
    sieve = key_sieve(listed, ["a", "b"], count, StagingArea(spark, "test"), "sieve")
    assert sieve.tag(listed, ["a", "b"], "__s", "maybe").filter("NOT maybe").isEmpty()
    tagged = sieve.tag(others, ["a", "b"], "__s", "maybe")
    assert tagged.columns == ["a", "b", "maybe"] and tagged.count() == 20_000
    assert tagged.filter("maybe").count() < 20_000 / 6


def test_keys_whose_equals_hash_apart_are_not_sieved(spark):
    whole = spark.createDataFrame([], "k bigint, t string, m struct<a:int>")
    part = spark.createDataFrame([], "k int, t string, m struct<a:int>")
    folded = spark.createDataFrame([], T.StructType([T.StructField("t", T.StringType("UTF8_LCASE"))]))
    assert can_sieve(whole, whole, ["k", "t"])
    assert not can_sieve(whole, part, ["k"])
    assert not can_sieve(whole, whole, ["m"])
    assert not can_sieve(folded, folded, ["t"])


def test_of_keys_too_many_to_broadcast_only_repeated_ones_are_ranked(spark, items):
    labelled = label_rows(items, [UniqueKeyRule(["id"])], look_ahead=True, broadcast_bytes=0)
    assert kept_out(spark, labelled) == 1
    assert labelled.filter("__rule__ = 0").count() == 1_000
    assert labelled.filter("__rule__ IS NULL").select("id").distinct().count() == 20_000


def test_of_orphans_too_many_to_broadcast_only_suspects_are_looked_up(spark, items):
    orders = spark.range(8_500).withColumnRenamed("id", "order_id")
    rules = [NotNullRule("order_id"), ReferentialIntegrityRule("order_id", orders, "order_id")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labelled = label_rows(items, rules, look_ahead=True, broadcast_bytes=0)
        # The suspect rows, and the list of missing keys.
        assert kept_out(spark, labelled) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    failed = items.filter("order_id >= 8500")
    assert labelled.filter("__rule__ = 1").drop("__rule__").exceptAll(failed).isEmpty()
    assert labelled.filter("__rule__ = 1").count() == failed.count() > 0
    assert labelled.count() == items.count()


def test_rows_a_delivery_cannot_match_are_not_shuffled(spark, items):
    delivery = items.filter("id % 40 = 1").withColumn("note", F.lit("new"))
    sieve = key_sieve(delivery, ["id"], 500, StagingArea(spark, "test"), "sieve")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = unmatched_rows(items, delivery, ["id"], sieve)
        assert kept_out(spark, left) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r.id for r in left.collect()) == sorted(r.id for r in items.filter("id % 40 <> 1").collect())


@pytest.mark.parametrize("partition_cols", [[], ["day"]])
def test_merges_through_a_sieve_equal_a_dictionary(spark, tmp_path, monkeypatch, partition_cols):
    monkeypatch.setattr(tables, "SIEVE_ROWS", 1)
    made = []
    monkeypatch.setattr(tables, "key_sieve", lambda *args: made.append(1) or key_sieve(*args))
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField(n, k) for n, k in (("k", T.LongType()), ("v", T.StringType()), ("day", T.IntegerType()))])
    create_table_if_not_exists(spark, schema, path, partition_cols)
    rng = random.Random(5)
    known, nulls = {}, []
    for n, size in enumerate([400, 60, 30]):
        rows = [(k, f"v{n}", rng.choice([None, 1, 2, 3])) for k in rng.sample(range(600), size)]
        delivery = spark.createDataFrame([*rows, (None, f"null{n}", n)], schema)
        result = write_table_merge(spark, delivery, path, ["k"])
        assert result.rows_updated == sum(k in known for k, _, _ in rows)
        known |= {row[0]: row for row in rows}
        nulls.append((None, f"null{n}", n))
        assert sorted(map(tuple, read_table(spark, path).collect()), key=str) == sorted([*known.values(), *nulls], key=str)
    assert len(made) == 2
