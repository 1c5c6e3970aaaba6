"""Each rule alone: who passes, who fails, and why."""

from __future__ import annotations

from datetime import datetime

import pytest

from sparkgate.operators.rules import (
    ERROR_COL,
    BooleanFlagRule,
    NotNullRule,
    PositiveAmountRule,
    ReferentialIntegrityRule,
    TimestampRangeRule,
    UniqueKeyRule,
)


def split(rule, df):
    valid, invalid = rule.validate(df)
    assert valid.columns == df.columns
    assert invalid.columns == [*df.columns, ERROR_COL]
    rejected = [tuple(r) for r in invalid.collect()]
    assert {r[-1] for r in rejected} <= {rule.reason}
    return sorted(map(tuple, valid.collect()), key=str), sorted(r[:-1] for r in rejected)


def test_not_null_accepts_nan_and_empty_text(spark):
    df = spark.createDataFrame([(None, "a"), (float("nan"), ""), (1.0, None)], "x double, s string")
    valid, invalid = split(NotNullRule("x"), df)
    assert len(valid) == 2 and invalid == [(None, "a")]
    assert len(split(NotNullRule("s"), df)[0]) == 2


def test_positive_amount_rejects_zero_negative_null_but_not_nan(spark):
    df = spark.createDataFrame([(0.0,), (-3.5,), (0.01,), (None,), (float("nan"),)], "x double")
    valid, invalid = PositiveAmountRule("x").validate(df)
    assert valid.count() == 2 and invalid.count() == 3


def test_flag_rejects_other_numbers_and_null(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (-1,), (None,)], "f int")
    valid, invalid = BooleanFlagRule("f").validate(df)
    assert sorted(r.f for r in valid.collect()) == [0, 1]
    assert invalid.count() == 3


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamp_range_is_closed_and_null_fails(spark, kind):
    moments = [
        "2020-01-01 00:00:00",
        "2019-12-31 23:59:59",
        "2030-12-31 00:00:00",
        "2030-12-31 00:00:01",
        None,
    ]
    df = spark.createDataFrame([(m,) for m in moments], "t string").selectExpr(
        f"cast(t as {kind}) as t"
    )
    rule = TimestampRangeRule("t", datetime(2020, 1, 1), datetime(2030, 12, 31))
    valid, invalid = rule.validate(df)
    assert valid.count() == 2 and invalid.count() == 3
    assert rule.reason == "'t' out of range [2020-01-01T00:00:00, 2030-12-31T00:00:00]"


def test_unique_keeps_the_first_by_all_columns(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z"), (1, "c")], "k int, v string")
    valid, invalid = split(UniqueKeyRule(["k"]), df.repartition(3))
    assert valid == [(1, "a"), (2, "z")]
    assert invalid == [(1, "b"), (1, "c")]


def test_unique_obeys_a_given_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b")], "k int, seq int, v string")
    valid, _ = split(UniqueKeyRule(["k"], order_by=["seq"]), df)
    assert valid == [(1, 3, "b")]


def test_unique_over_two_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 1)], "a int, b int")
    rule = UniqueKeyRule(["a", "b"])
    valid, invalid = split(rule, df)
    assert valid == [(1, 1), (1, 2)] and invalid == [(1, 1)]
    assert rule.rule_name == "unique_key:a|b"
    assert rule.reason == "duplicate key on columns: ['a', 'b']"


def test_unique_treats_null_keys_as_one_group(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    valid, invalid = split(UniqueKeyRule(["k"]), df)
    assert (None, "a") in valid and invalid == [(None, "b")]


def test_foreign_key_rejects_orphans_and_nulls_and_keeps_column_order(spark):
    df = spark.createDataFrame([(10, 1), (11, 99), (12, None)], "id int, order_id int")
    orders = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "oid bigint, v string")
    rule = ReferentialIntegrityRule("order_id", orders, "oid")
    valid, invalid = rule.validate(df)
    assert [tuple(r) for r in valid.collect()] == [(10, 1)]
    assert sorted(r.id for r in invalid.collect()) == [11, 12]
    assert "'order_id' not found in reference table column 'oid'" in rule.reason


def test_foreign_key_against_nothing_rejects_all(spark):
    df = spark.createDataFrame([(10, 1)], "id int, order_id int")
    valid, invalid = ReferentialIntegrityRule("order_id", df.limit(0), "order_id").validate(df)
    assert valid.count() == 0 and invalid.count() == 1


def test_foreign_key_into_the_same_frame(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 7)], "id int, parent int")
    valid, _ = ReferentialIntegrityRule("parent", df, "id").validate(df)
    assert [r.id for r in valid.collect()] == [2]


def test_rule_names():
    assert NotNullRule("a").rule_name == "not_null:a"
    assert PositiveAmountRule("a").rule_name == "positive_amount:a"
    assert BooleanFlagRule("a").rule_name == "boolean_flag:a"
    moment = datetime(2020, 1, 1)
    assert TimestampRangeRule("a", moment, moment).rule_name == "timestamp_range:a"
