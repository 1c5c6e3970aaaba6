"""The ladder: an ordered rule list applied to a frame in one pass.

One integer column holds, per row, the place of the first rule the row fails, or null. Each rule
judges only the rows still unmarked, which is what applying the rules one after another to the
survivors means. Runs of predicate rules fuse into one projection; only window and join rules
shuffle. Splitting into valid and invalid is a filter on the label, at the very end.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from sparkgate.operators.rules import (
    ERROR_COL,
    MarkContext,
    MarkingRule,
    PredicateRule,
    StatefulRule,
    UniqueKeyRule,
    ValidationRule,
)
from sparkgate.operators.skew import (
    BROADCAST_BYTES,
    DEFAULT_HOT_ROWS,
    comparable_columns,
    quoted,
    spread,
)
from sparkgate.sources.staging import StagingArea

RULE_COL = "__rule__"
# Only present with rules that split for themselves: the reason such a rule gave.
REASON_COL = "__reason__"
_SPREAD_COL = "__spread__"


def label_rows(
    df: DataFrame,
    rules: Sequence[ValidationRule],
    *,
    order_by: Sequence[str] = (),
    look_ahead: bool = False,
    staging: StagingArea | None = None,
    hot_rows: int = DEFAULT_HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """df plus ``__rule__``: the place in rules of the first rule the row fails, null if none.

    order_by says which row of a duplicated key is the first.

    By default nothing runs until the result is used, df is evaluated once, and rules over keys
    shuffle all rows by key, hot keys split.

    look_ahead is for a df that reads stored rows, which are the same each time. Unique-key and
    foreign-key rules then look at its keys first, each in a narrow job run at once, and shuffle
    few rows or none: broadcast_bytes is how large a list of repeated or missing keys may be
    broadcast, hot_rows from which counted size on a repeated key is ranked in two rounds. The
    plan follows from these counts alone, at every size of df.

    What is stored on the way goes to staging, by default a folder of its own in the checkpoint
    folder. It must stay until the result has been used.
    """
    columns = df.columns
    frame = df
    carried = list(columns)
    if any(isinstance(rule, StatefulRule) for rule in rules):
        frame = frame.withColumn(_SPREAD_COL, spread(df))
        carried.append(_SPREAD_COL)
    if any(not isinstance(rule, MarkingRule) for rule in rules):
        frame = frame.withColumn(REASON_COL, F.lit(None).cast("string"))
        carried.append(REASON_COL)

    preview = df if look_ahead else None
    splits = any(not isinstance(rule, MarkingRule) for rule in rules)
    if staging is None and (look_ahead or splits):
        staging = StagingArea(df.sparkSession, "ladder")

    label: Column = F.lit(None).cast("int")
    for place, rule in enumerate(rules):
        if isinstance(rule, PredicateRule):
            fails = rule.fails(df.schema)
            label = F.coalesce(label, F.when(fails, F.lit(place)))
            if preview is not None:
                preview = preview.filter(~fails)
            continue
        frame = frame.select(*quoted(carried), label.alias(RULE_COL))
        label = F.col(RULE_COL)
        if isinstance(rule, StatefulRule):
            frame, fails = rule.mark(
                frame,
                MarkContext(
                    columns=columns,
                    alive=label.isNull(),
                    spread=F.col(_SPREAD_COL),
                    prefix=f"__mark{place}",
                    order_by=order_by,
                    preview=preview,
                    staging=staging,
                    hot_rows=hot_rows,
                    broadcast_bytes=broadcast_bytes,
                ),
            )
            label = F.coalesce(label, F.when(fails, F.lit(place)))
        else:
            # Stored first: three branches read it, which would each run all that came before.
            frame = _split_with(staging.write(frame, f"before_rule_{place}"), rule, place)
    if _SPREAD_COL in carried:
        carried.remove(_SPREAD_COL)
    return frame.select(*quoted(carried), label.alias(RULE_COL))


def narrowed_to_count(
    df: DataFrame, rules: Sequence[ValidationRule], *, order_by: Sequence[str] = ()
) -> DataFrame:
    """df with the columns that decide how many rows fail each rule, in their order.

    Besides the columns that rules read these are the ones that tell which row of a duplicated key
    is the first: up to the last that a later rule reads. Rows that are alike up to there are alike
    to all later rules, so it does not matter which of them stays. With a rule that does not tell
    what it reads, all columns are needed.
    """
    reads = [rule.columns_read() for rule in rules]
    if any(columns is None for columns in reads):
        return df
    needed = {name for columns in reads for name in columns}
    for place, rule in enumerate(rules):
        if isinstance(rule, UniqueKeyRule):
            later = {name for columns in reads[place + 1 :] for name in columns} - set(rule.keys)
            order = [*(rule.order_by or order_by)]
            order += [name for name in comparable_columns(df) if name not in order and name not in rule.keys]
            last = max((n for n, name in enumerate(order) if name in later), default=-1)
            needed.update(order[: last + 1])
    return df.select(*quoted([name for name in df.columns if name in needed]))


def _split_with(frame: DataFrame, rule: ValidationRule, place: int) -> DataFrame:
    """Apply a rule that splits for itself, keeping the reason it gives."""
    alive = frame.filter(F.col(RULE_COL).isNull()).drop(RULE_COL, REASON_COL)
    failed_before = frame.filter(F.col(RULE_COL).isNotNull())
    valid, invalid = rule.validate(alive)
    return (
        valid.withColumn(REASON_COL, F.lit(None).cast("string"))
        .withColumn(RULE_COL, F.lit(None).cast("int"))
        .unionByName(
            invalid.withColumnRenamed(ERROR_COL, REASON_COL).withColumn(RULE_COL, F.lit(place))
        )
        .unionByName(failed_before)
    )


def reason_of(rules: Sequence[ValidationRule]) -> Column:
    """Reason text of a labelled row, from the place of its rule."""
    if not rules:
        return F.lit(None).cast("string")
    reasons = [r.reason if isinstance(r, MarkingRule) else r.rule_name for r in rules]
    return F.array(*[F.lit(text) for text in reasons])[F.col(RULE_COL)]


def surviving_rows(labelled: DataFrame) -> DataFrame:
    """Rows that passed every rule, in the input's columns."""
    return labelled.filter(F.col(RULE_COL).isNull()).drop(RULE_COL, REASON_COL)


def rejected_rows(labelled: DataFrame, rules: Sequence[ValidationRule]) -> DataFrame:
    """Rows that failed a rule, with ``__error_reason__`` saying which."""
    reason = reason_of(rules)
    if REASON_COL in labelled.columns:
        reason = F.coalesce(F.col(REASON_COL), reason)
    return (
        labelled.filter(F.col(RULE_COL).isNotNull())
        .withColumn(ERROR_COL, reason)
        .drop(RULE_COL, REASON_COL)
    )
