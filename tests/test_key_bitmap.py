"""Bitmaps of reference keys against plain sets."""

from __future__ import annotations

import random

import pyspark.sql.functions as F
import pytest

from sparkgate.errors import SchemaError
from sparkgate.operators.key_bitmap import (
    BUCKET_COL,
    key_bitmaps,
    key_count,
    known_rows,
    merged_bitmaps,
    orphan_rows,
)
from sparkgate.operators.rules import ReferentialIntegrityRule
from sparkgate.plans.audits import AuditState, orders_sanity, products_sanity

EDGES = [0, 1, -1, 7, 8, 32767, 32768, 32769, 65536, 65537, -32767, -32768, -32769, 2**40, 2**63 - 1, -(2**63) + 1]


def frame(spark, keys, kind="long"):
    return spark.createDataFrame([(k, n) for n, k in enumerate(keys)], f"`a.k` {kind}, n int")


@pytest.mark.parametrize("seed", range(3))
def test_known_and_orphan_rows_equal_sets(spark, seed):
    rng = random.Random(seed)
    pool = EDGES + [rng.randrange(-70_000, 70_000) for _ in range(500)]
    reference = [rng.choice(pool) for _ in range(300)] + [None]
    rows = [*pool, None, None]
    bitmaps = key_bitmaps(frame(spark, reference), "a.k")
    held = {k for k in reference if k is not None}
    known = known_rows(frame(spark, rows), "a.k", bitmaps)
    orphans = orphan_rows(frame(spark, rows), "a.k", bitmaps)
    assert known.columns == orphans.columns == ["a.k", "n"]
    assert sorted(r.n for r in known.collect()) == [n for n, k in enumerate(rows) if k in held]
    assert sorted(r.n for r in orphans.collect()) == [n for n, k in enumerate(rows) if k not in held]
    assert bitmaps.agg(key_count()).first()[0] == len(held)


def test_bitmaps_of_parts_merge_to_that_of_the_whole(spark):
    keys = [*range(0, 90_000, 3), *range(0, 90_000, 5)]
    parts = key_bitmaps(frame(spark, keys[:20_000]), "a.k").union(key_bitmaps(frame(spark, keys[20_000:]), "a.k"))
    merged = merged_bitmaps(parts)
    assert merged.count() == 4 < parts.count()
    assert merged.agg(key_count()).first()[0] == len(set(keys))
    whole = {(r[BUCKET_COL], bytes(r["__bits__"])) for r in key_bitmaps(frame(spark, keys), "a.k").collect()}
    assert {(r[BUCKET_COL], bytes(r["__bits__"])) for r in merged.collect()} == whole


def test_empty_references_and_other_types(spark):
    none = key_bitmaps(frame(spark, [], "int"), "a.k")
    assert none.count() == 0 and none.agg(key_count()).first()[0] == 0
    assert orphan_rows(frame(spark, [1, None], "int"), "a.k", none).count() == 2
    with pytest.raises(SchemaError, match="integer"):
        key_bitmaps(spark.createDataFrame([("x",)], "k string"), "k")


@pytest.mark.parametrize("look_ahead", [False, True])
def test_the_rule_by_bitmaps_equals_the_plain_rule(spark, look_ahead, tmp_path):
    from sparkgate.operators.ladder import label_rows

    rng = random.Random(4)
    rows = spark.createDataFrame([(rng.choice([None, 3, 5, rng.randrange(900)]), n) for n in range(800)], "k int, n int")
    reference = spark.createDataFrame([(rng.randrange(600),) for _ in range(400)], "k int")
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")

    def label(**options):
        rules = [ReferentialIntegrityRule("k", reference, "k", **options)]
        return {(r.n, r["__rule__"]) for r in label_rows(rows, rules, look_ahead=look_ahead).collect()}

    assert label(dense_keys=True) == label()


def test_the_reference_is_shuffled_as_bitmaps(spark):
    reference = spark.range(200_000).withColumnRenamed("id", "k")
    rule = ReferentialIntegrityRule("k", reference, "k", dense_keys=True)
    valid, _ = rule.validate(spark.range(1000).withColumnRenamed("id", "k"))
    assert valid.count() == 1000
    assert key_bitmaps(reference, "k").count() == 8


def test_audits_over_deliveries_equal_audits_of_all(spark, tmp_path):
    def products(rows):
        return spark.createDataFrame(rows, "product_id int, department string")

    parts = [[(1, "a"), (2, "b"), (None, "a")], [(2, "c"), (40_000, None)], []]
    state = AuditState(f"{tmp_path}/p")
    for n, rows in enumerate(parts):
        state.add_products(products(rows), f"d:{n}")
    state.add_products(products(parts[1]), "d:1")
    everything = products([row for rows in parts for row in rows])
    assert state.products_sanity(spark).collect() == products_sanity(everything).collect()

    ddl = "order_id long, total_amount double, order_timestamp timestamp"
    orders = spark.range(90).select(
        "id", F.when(F.col("id") % 7 > 0, F.col("id") * 1.0 - 3), F.timestamp_seconds(F.col("id") * 1000)
    ).toDF("order_id", "total_amount", "order_timestamp").to(spark.createDataFrame([], ddl).schema)
    state = AuditState(f"{tmp_path}/o")
    for n in range(3):
        state.add_orders(orders.filter(F.col("order_id") % 3 == n).union(orders.limit(n)), str(n))
    whole = orders.union(orders.limit(1)).union(orders.limit(2))
    assert state.orders_sanity(spark).collect() == orders_sanity(whole).collect()
