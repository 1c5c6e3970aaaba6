"""The ordered rule lists of the three tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from sparkgate.operators.rules import (
    BooleanFlagRule,
    NotNullRule,
    PositiveAmountRule,
    ReferentialIntegrityRule,
    TimestampRangeRule,
    UniqueKeyRule,
    ValidationRule,
)

# Timestamps outside this closed range are data errors.
DEFAULT_MIN_TS = datetime(2020, 1, 1)
DEFAULT_MAX_TS = datetime(2030, 12, 31)


def products_rules() -> list[ValidationRule]:
    # Rules, columns and their order.
    return [
        NotNullRule("product_id"),
        UniqueKeyRule(["product_id"]),
        NotNullRule("department"),
        NotNullRule("product_name"),
    ]


def orders_rules(
    min_ts: datetime = DEFAULT_MIN_TS, max_ts: datetime = DEFAULT_MAX_TS
) -> list[ValidationRule]:
    # Rules, columns and their order.
    return [
        NotNullRule("order_id"),
        UniqueKeyRule(["order_id"]),
        NotNullRule("user_id"),
        NotNullRule("order_timestamp"),
        PositiveAmountRule("total_amount"),
        TimestampRangeRule("order_timestamp", min_ts, max_ts),
    ]


def order_items_rules(
    orders: DataFrame,
    min_ts: datetime = DEFAULT_MIN_TS,
    max_ts: datetime = DEFAULT_MAX_TS,
    *,
    dense_keys: bool = False,
) -> list[ValidationRule]:
    # Rules, columns and their order.
    return [
        NotNullRule("id"),
        NotNullRule("order_id"),
        NotNullRule("product_id"),
        UniqueKeyRule(["id"]),
        BooleanFlagRule("reordered"),
        ReferentialIntegrityRule("order_id", orders, "order_id", dense_keys=dense_keys),
        TimestampRangeRule("order_timestamp", min_ts, max_ts),
    ]
