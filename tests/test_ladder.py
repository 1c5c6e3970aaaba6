"""The ladder equals applying the rules one after another, whatever the data and the rule order."""

from __future__ import annotations

import math
import random

import pyspark.sql.functions as F
import pytest

from sparkgate.operators.ladder import (
    REASON_COL,
    RULE_COL,
    label_rows,
    rejected_rows,
    surviving_rows,
)
from sparkgate.operators.rules import (
    ERROR_COL,
    BooleanFlagRule,
    NotNullRule,
    PositiveAmountRule,
    ReferentialIntegrityRule,
    UniqueKeyRule,
    ValidationRule,
)
from sparkgate.operators.validation import (
    DataQualityValidator,
    check_threshold,
    rule_results,
    validation_summary,
)
from sparkgate.errors import ValidationError
from sparkgate.sources.staging import StagingArea

SCHEMA = "id int, ref int, amount double, flag int"
RANKED = lambda row: tuple((v is not None, v or 0) for v in row)


class OddAmountRule(ValidationRule):
    """A rule that only knows how to split."""

    rule_name = "odd_amount:amount"

    def validate(self, df):
        odd = F.coalesce(F.col("amount") % 2 == 1, F.lit(False))
        return df.filter(~odd), df.filter(odd).withColumn(ERROR_COL, F.lit("odd"))


def make_rows(seed: int, n: int = 300) -> list[tuple]:
    draw = random.Random(seed)
    hot = (7, 1, 5.0, 0)
    pick = lambda *values: draw.choice(values)
    rows = [
        (pick(None, draw.randrange(40)), pick(None, draw.randrange(12)),
         pick(None, -1.0, 0.0, float(draw.randrange(9))), pick(None, 0, 1, 2))
        for _ in range(n)
    ]
    # A third of all rows share one key, many of them exact copies.
    return rows + [hot] * (n // 4) + [(7, 1, float(k), 1) for k in range(n // 4)]


KNOWN = {0, 1, 2, 3, 5}


def chain_of(rules: list, rows: list[tuple]) -> list[tuple]:
    """Brute force: (place of first failed rule or None, row), rule by rule."""
    alive = list(rows)
    out = []
    for place, rule in enumerate(rules):
        if isinstance(rule, NotNullRule):
            bad = [r for r in alive if r[SCHEMA_NAMES.index(rule.column)] is None]
        elif isinstance(rule, PositiveAmountRule):
            bad = [r for r in alive if not (r[2] is not None and r[2] > 0)]
        elif isinstance(rule, BooleanFlagRule):
            bad = [r for r in alive if r[3] not in (0, 1)]
        elif isinstance(rule, ReferentialIntegrityRule):
            bad = [r for r in alive if r[1] not in KNOWN]
        elif isinstance(rule, OddAmountRule):
            bad = [r for r in alive if r[2] is not None and math.fmod(r[2], 2) == 1]
        else:
            bad, seen = [], set()
            for r in sorted(alive, key=RANKED):
                key = tuple(r[SCHEMA_NAMES.index(k)] for k in rule.keys)
                if key in seen:
                    bad.append(r)
                seen.add(key)
        left = list(alive)
        for r in bad:
            left.remove(r)
        alive = left
        out += [(place, *r) for r in bad]
    return out + [(None, *r) for r in alive]


SCHEMA_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def rule_lists(spark):
    known = spark.createDataFrame([(k,) for k in KNOWN], "ref int")
    fk = ReferentialIntegrityRule("ref", known, "ref")
    return {
        "usual": [NotNullRule("id"), UniqueKeyRule(["id"]), BooleanFlagRule("flag"), fk,
                  PositiveAmountRule("amount")],
        "unique first": [UniqueKeyRule(["id"]), NotNullRule("id"), PositiveAmountRule("amount")],
        "two unique": [UniqueKeyRule(["id", "ref"]), fk, UniqueKeyRule(["id"])],
        "key before unique": [fk, PositiveAmountRule("amount"), UniqueKeyRule(["ref"])],
        "own rule": [NotNullRule("ref"), OddAmountRule(), UniqueKeyRule(["id"]),
                     BooleanFlagRule("flag")],
        "stateless": [NotNullRule("id"), PositiveAmountRule("amount"), BooleanFlagRule("flag")],
        "none": [],
    }


PLANS = {
    "default": {},
    "not looking": {"look_ahead": False},
    "broadcast": {"look_ahead": True},
    "shuffled": {"look_ahead": True, "broadcast_bytes": 0},
    "hot shuffled": {"look_ahead": True, "broadcast_bytes": 0, "hot_rows": 20},
    "hot broadcast": {"look_ahead": True, "hot_rows": 20},
}


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("name", ["usual", "unique first", "two unique", "key before unique",
                                  "own rule", "stateless", "none"])
def test_ladder_equals_the_chain(spark, name, plan):
    rules = rule_lists(spark)[name]
    rows = make_rows(seed=len(name))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    labelled = label_rows(df, rules, **PLANS[plan])
    assert labelled.drop(REASON_COL).columns == [*SCHEMA_NAMES, RULE_COL]
    labelled = labelled.drop(REASON_COL)
    found = sorted(((r[-1], *r[:-1]) for r in labelled.collect()), key=RANKED)
    assert found == sorted(chain_of(rules, rows), key=RANKED)


def test_own_rules_keep_their_reasons(spark):
    df = spark.createDataFrame([(None, 1, 2.0, 1), (1, 1, 3.0, 1), (2, 1, 4.0, 1)], SCHEMA)
    rules = [NotNullRule("id"), OddAmountRule()]
    labelled = label_rows(df, rules)
    assert {(r.id, r[ERROR_COL]) for r in rejected_rows(labelled, rules).collect()} == {
        (None, NotNullRule("id").reason), (1, "odd")}
    assert [r.id for r in surviving_rows(labelled).collect()] == [2]
    assert surviving_rows(labelled).columns == SCHEMA_NAMES


def test_large_reference_takes_the_shuffle_join_with_the_same_result(spark):
    rules = rule_lists(spark)["usual"]
    rows = make_rows(seed=3)
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labelled = label_rows(df, rules, look_ahead=False)
        found = sorted(((r[-1], *r[:-1]) for r in labelled.collect()), key=RANKED)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == sorted(chain_of(rules, rows), key=RANKED)


def test_valid_and_rejected_partition_the_input(spark):
    rules = rule_lists(spark)["usual"]
    df = spark.createDataFrame(make_rows(seed=1), SCHEMA)
    labelled = label_rows(df, rules)
    rejected = rejected_rows(labelled, rules)
    back = surviving_rows(labelled).unionByName(rejected.drop(ERROR_COL))
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert rejected.filter(F.col(ERROR_COL).isNull()).count() == 0


@pytest.mark.parametrize("staged", [False, True])
def test_validator_counts(spark, staged):
    rules = rule_lists(spark)["usual"]
    rows = make_rows(seed=2)
    expected = chain_of(rules, rows)
    df = spark.createDataFrame(rows, SCHEMA)
    area = StagingArea(spark, "test") if staged else None
    result = DataQualityValidator(rules, staging=area).validate(df)
    failed = [sum(1 for e in expected if e[0] == n) for n in range(len(rules))]
    assert [r.records_failed for r in result.rule_results] == failed
    assert result.total_records == len(rows)
    assert result.records_passed == len(rows) - sum(failed)
    assert result.failure_ratio == sum(failed) / len(rows)
    assert not result.passed
    assert result.valid_df.count() == result.records_passed
    assert result.invalid_df.count() == result.records_failed
    assert result.valid_df.columns == SCHEMA_NAMES
    first = result.rule_results[0]
    assert (first.rule_name, first.error_column) == ("not_null:id", "id")
    assert first.error_message == f"{failed[0]} record(s) failed rule 'not_null:id'"

    table = {r.rule_name: r for r in rule_results(label_rows(df, rules), rules).collect()}
    assert [table[r.rule_name].records_failed for r in rules] == failed
    assert validation_summary(label_rows(df, rules)).first().records_failed == sum(failed)
    if staged:
        area.clear()


def test_rules_that_fail_nothing_still_get_a_result(spark):
    df = spark.createDataFrame([(1, 1, 5.0, 1)], SCHEMA)
    rules = rule_lists(spark)["stateless"]
    result = DataQualityValidator(rules).validate(df)
    assert result.passed and result.failure_ratio == 0.0
    assert [r.passed for r in result.rule_results] == [True, True, True]
    assert result.invalid_df.columns == [*SCHEMA_NAMES, ERROR_COL]
    assert result.invalid_df.count() == 0
    assert rule_results(label_rows(df, rules), rules).filter("passed").count() == 3


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    result = DataQualityValidator(rule_lists(spark)["usual"]).validate(df)
    assert (result.total_records, result.failure_ratio, result.passed) == (0, 0.0, True)
    assert validation_summary(label_rows(df, [])).first().failure_ratio == 0.0


def test_gate_is_strict(spark):
    df = spark.createDataFrame([(None, 1, 5.0, 1), (1, 1, 5.0, 1)], SCHEMA)
    result = DataQualityValidator([NotNullRule("id")]).validate(df)
    check_threshold(result, 0.5)
    with pytest.raises(ValidationError) as caught:
        check_threshold(result, 0.49)
    assert caught.value.failure_ratio == 0.5
