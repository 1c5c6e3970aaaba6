"""Data-quality rules.

A rule adds its verdict to a frame instead of splitting it: ``mark`` returns the frame, perhaps
with helper columns, and a non-null boolean column telling which of the rows still alive fail.
The ladder strings rules together; ``validate`` applies one rule alone and splits the result.

To add a rule, subclass PredicateRule when a row can be judged alone, StatefulRule when it takes a
window or a join, or ValidationRule with a ``validate`` of your own when it is simplest to split.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import types as T

from sparkgate.operators.key_bitmap import BITS_COL, BUCKET_COL, bucket_of, holds, key_bitmaps
from sparkgate.operators.sieve import can_sieve, key_sieve
from sparkgate.operators.skew import (
    SPREAD_WIDTH,
    comparable_columns,
    key_width,
    missing_keys,
    quoted,
    repeated_keys,
    tag_keys,
)
from sparkgate.sources.staging import StagingArea

ERROR_COL = "__error_reason__"

# Reject reasons, as stored in __error_reason__.
NULL_REASON = "null value in required column '{column}'"
DUPLICATE_REASON = "duplicate key on columns: {keys}"
ORPHAN_REASON = (
    "referential_integrity_violation: '{column}' not found in reference table column '{ref_column}'"
)
RANGE_REASON = "'{column}' out of range [{low}, {high}]"
AMOUNT_REASON = "'{column}' must be > 0"
FLAG_REASON = "'{column}' must be 0 or 1"


@dataclass(frozen=True)
class MarkContext:
    """What the ladder tells a stateful rule."""

    columns: list[str]  # input columns
    alive: Column  # rows no earlier rule has failed
    spread: Column  # subgroup number, see operators.skew
    prefix: str  # for helper columns, unique per rule
    order_by: Sequence[str]
    # Stored input rows to look at before choosing a plan, all those alive among them, and where
    # to keep what is found; None to not look.
    preview: DataFrame | None
    staging: StagingArea | None
    hot_rows: int
    broadcast_bytes: int


class ValidationRule(ABC):
    """Extension point: a name, and a split into valid and invalid rows."""

    @property
    @abstractmethod
    def rule_name(self) -> str:
        """Identifier ``<kind>:<columns>`` used in results."""

    @abstractmethod
    def validate(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(valid, invalid) rows of df; invalid has the added column ``__error_reason__``."""

    def columns_read(self) -> list[str] | None:
        """Columns that decide whether a row fails; None if that cannot be told."""
        return None


class MarkingRule(ValidationRule):
    """A rule the ladder can apply without splitting the frame."""

    @property
    @abstractmethod
    def reason(self) -> str:
        """Text stored in ``__error_reason__``."""

    def validate(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        from sparkgate.operators.ladder import label_rows, rejected_rows, surviving_rows

        labelled = label_rows(df, [self])
        return surviving_rows(labelled), rejected_rows(labelled, [self])


class PredicateRule(MarkingRule):
    """A rule that judges each row alone."""

    @abstractmethod
    def fails(self, schema: T.StructType) -> Column:
        """Non-null boolean: the row breaks the rule."""


class StatefulRule(MarkingRule):
    """A rule that needs other rows."""

    @abstractmethod
    def mark(self, df: DataFrame, context: MarkContext) -> tuple[DataFrame, Column]:
        """df with helper columns named after context.prefix, and which rows fail."""


def _holds(predicate: Column) -> Column:
    """Null-aware truth: a null predicate does not hold."""
    return F.coalesce(predicate, F.lit(False))


class ColumnRule(PredicateRule):
    """A predicate rule over one column."""

    kind: str
    reason_format: str

    def __init__(self, column: str) -> None:
        self.column = column

    @property
    def value(self) -> Column:
        return quoted([self.column])[0]

    @property
    def rule_name(self) -> str:
        return f"{self.kind}:{self.column}"

    def columns_read(self) -> list[str] | None:
        return [self.column]

    @property
    def reason(self) -> str:
        return self.reason_format.format(column=self.column)


class NotNullRule(ColumnRule):
    """The column must not be null. NaN and empty text pass."""

    kind = "not_null"
    reason_format = NULL_REASON

    def fails(self, schema: T.StructType) -> Column:
        return self.value.isNull()


class PositiveAmountRule(ColumnRule):
    """The column must be above zero; null fails."""

    kind = "positive_amount"
    reason_format = AMOUNT_REASON

    def fails(self, schema: T.StructType) -> Column:
        return ~_holds(self.value > 0)


class BooleanFlagRule(ColumnRule):
    """The column must be 0 or 1; null fails."""

    kind = "boolean_flag"
    reason_format = FLAG_REASON

    def fails(self, schema: T.StructType) -> Column:
        return ~_holds(self.value.isin(0, 1))


class TimestampRangeRule(ColumnRule):
    """The column must lie in the closed range [min_ts, max_ts]; null fails.

    Naive bounds are read in the session time zone, or as wall-clock time when the column itself
    carries no zone.
    """

    kind = "timestamp_range"

    def __init__(self, column: str, min_ts: datetime, max_ts: datetime) -> None:
        super().__init__(column)
        self.bounds = (min_ts, max_ts)

    @property
    def reason(self) -> str:
        low, high = (bound.isoformat() for bound in self.bounds)
        return RANGE_REASON.format(column=self.column, low=low, high=high)

    def fails(self, schema: T.StructType) -> Column:
        zoneless = isinstance(schema[self.column].dataType, T.TimestampNTZType)
        bound_type = "timestamp_ntz" if zoneless else "timestamp"
        low, high = (F.lit(bound.isoformat(sep=" ")).cast(bound_type) for bound in self.bounds)
        return ~_holds(self.value.between(low, high))


class UniqueKeyRule(StatefulRule):
    """The first row of each key passes, the others fail. Null keys form one group.

    First means first by order_by, then by all other columns, so that the choice does not depend
    on how the input is split into files.

    Rows are ranked in two rounds, first in subgroups of their key, then among the subgroups'
    winners, so that no key's rows meet in one task, however many they are. When the ladder looks
    ahead, repeated keys are counted first: with none, no row can fail; if they can be broadcast,
    only their rows are ranked and all others stay where they are; if not, so do rows that a sieve
    of them rules out; and one round is enough when none of them is hot.
    """

    def __init__(self, key_columns: list[str], order_by: Sequence[str] = ()) -> None:
        self.keys = list(key_columns)
        self.order_by = list(order_by)

    @property
    def rule_name(self) -> str:
        return f"unique_key:{'|'.join(self.keys)}"

    def columns_read(self) -> list[str] | None:
        return [*self.keys, *self.order_by]

    @property
    def reason(self) -> str:
        return DUPLICATE_REASON.format(keys=self.keys)

    def mark(self, df: DataFrame, context: MarkContext) -> tuple[DataFrame, Column]:
        first = f"{context.prefix}_first"
        fails = context.alive & ~F.col(first)
        if context.preview is None:
            return self._rank(df, context, True, first), fails

        repeated = repeated_keys(
            context.preview, self.keys, context.staging, f"{context.prefix}_repeated"
        )
        size, most, count = repeated.agg(F.sum(key_width(self.keys)), F.max("n"), F.count(F.lit(1))).first()
        if size is None:
            return df, F.lit(False)
        split = most > context.hot_rows
        contested = f"{context.prefix}_contested"
        if size <= context.broadcast_bytes:
            tagged = tag_keys(df, self.keys, repeated, context.prefix, contested)
        elif can_sieve(df, repeated, self.keys):
            sieve = key_sieve(repeated, self.keys, count, context.staging, f"{context.prefix}_sieve")
            tagged = sieve.tag(df, self.keys, context.prefix, contested)
        else:
            return self._rank(df, context, split, first), fails
        contest = F.col(contested) & context.alive
        ranked = self._rank(tagged.filter(contest), context, split, first)
        return tagged.filter(~contest).withColumn(first, F.lit(True)).unionByName(ranked), fails

    def _rank(
        self, df: DataFrame, context: MarkContext, split: bool, first: str
    ) -> DataFrame:
        """df plus a boolean: the row is the first of its key among the rows alive."""
        leading = [*(self.order_by or context.order_by)]
        rest = [c for c in comparable_columns(df) if c in context.columns]
        order = quoted(leading + [c for c in rest if c not in leading and c not in self.keys])
        keys = quoted(self.keys)

        def leads(group: Column) -> Column:
            window = Window.partitionBy(*keys, group).orderBy(*(order or [F.lit(1)]))
            return F.row_number().over(window) == 1

        # Rows already failed only ride along: they must not gather under one key.
        apart = context.spread + SPREAD_WIDTH
        if not split:
            return df.withColumn(first, leads(F.when(context.alive, F.lit(0)).otherwise(apart)))
        subgroup = F.when(context.alive, context.spread).otherwise(apart)
        df = df.withColumn(first, context.alive & leads(subgroup))
        final = F.when(F.col(first), F.lit(-1)).otherwise(apart)
        return df.withColumn(first, F.col(first) & leads(final))


class ReferentialIntegrityRule(StatefulRule):
    """The foreign key must occur in the reference column; null fails.

    Rows are joined with the distinct reference keys: rows with nothing to look up get a padded
    key, which matches nothing and hashes apart, and hot foreign keys are split by adaptive
    execution. When the ladder looks ahead, keys missing from the reference are looked for first,
    among the distinct foreign keys: with none, only nulls fail; if they can be broadcast, rows
    stay where they are; if not, so do rows that a sieve of them rules out.

    dense_keys declares that both columns are integers and the reference's lie close together, as
    counted ids do. The reference is then taken as bitmaps, see operators.key_bitmap, and rows meet
    a stretch of keys each.
    """

    def __init__(self, fk_column: str, reference_df: DataFrame, ref_column: str, *, dense_keys: bool = False) -> None:
        self.fk = fk_column
        self.reference_df = reference_df
        self.ref_column = ref_column
        self.dense_keys = dense_keys

    @property
    def rule_name(self) -> str:
        return f"referential_integrity:{self.fk}"

    def columns_read(self) -> list[str] | None:
        return [self.fk]

    @property
    def reason(self) -> str:
        return ORPHAN_REASON.format(column=self.fk, ref_column=self.ref_column)

    def mark(self, df: DataFrame, context: MarkContext) -> tuple[DataFrame, Column]:
        foreign = F.col(f"`{self.fk}`")
        if context.preview is None:
            return self._look_up(df, context)

        missing = missing_keys(
            context.preview, self.fk, self.reference_df, self.ref_column,
            context.staging, f"{context.prefix}_missing", dense_keys=self.dense_keys,
        )
        size, count = missing.agg(F.sum(key_width([self.fk])), F.count(F.lit(1))).first()
        if size is None:
            return df, context.alive & foreign.isNull()
        orphan = f"{context.prefix}_orphan"
        if size <= context.broadcast_bytes:
            df = tag_keys(df, [self.fk], missing, context.prefix, orphan)
        elif not self.dense_keys and can_sieve(df, missing, [self.fk]):
            suspect = f"{context.prefix}_suspect"
            sieve = key_sieve(missing, [self.fk], count, context.staging, f"{context.prefix}_sieve")
            df = self._tag_orphans(sieve.tag(df, [self.fk], context.prefix, suspect), suspect, missing, context, orphan)
        else:
            return self._look_up(df, context)
        return df, context.alive & (foreign.isNull() | F.col(orphan))

    def _tag_orphans(
        self, df: DataFrame, suspect: str, missing: DataFrame, context: MarkContext, orphan: str
    ) -> DataFrame:
        """df plus a boolean: its foreign key is missing. Only suspect rows are joined with the missing keys."""
        key = f"{context.prefix}_key"
        doubtful = context.alive & F.col(suspect) & F.col(f"`{self.fk}`").isNotNull()
        listed = missing.select(F.col(f"`{self.fk}`").alias(key), F.lit(True).alias(orphan))
        joined = df.filter(doubtful).join(listed, F.col(f"`{self.fk}`") == F.col(key), "left").drop(key)
        joined = joined.withColumn(orphan, F.col(orphan).isNotNull())
        return df.filter(~doubtful).withColumn(orphan, F.lit(False)).unionByName(joined)

    def _look_up(self, df: DataFrame, context: MarkContext) -> tuple[DataFrame, Column]:
        key, pad, found = (f"{context.prefix}_{part}" for part in ("key", "pad", "found"))
        ref_key = F.col(f"`{self.ref_column}`")
        # Padded after the distinct, so that the join shuffles it anew: adaptive execution splits
        # hot keys only where a join reads straight from a shuffle. The pad is zero for every key
        # but no literal, which would be folded out of the join key.
        wanted = F.when(context.alive, F.col(f"`{self.fk}`"))
        if self.dense_keys:
            reference = key_bitmaps(self.reference_df, self.ref_column).select(
                F.col(BUCKET_COL).alias(key), F.hash(BUCKET_COL).bitwiseAND(F.lit(0)).alias(pad), F.col(BITS_COL).alias(found)
            )
            wanted_pad = F.when(wanted.isNotNull(), F.lit(0)).otherwise(context.spread + 1)
            df = df.join(reference, (bucket_of(wanted) == F.col(key)) & (wanted_pad == F.col(pad)), "left")
            df = df.withColumn(found, holds(F.col(found), wanted))
            return df, context.alive & ~F.col(found)
        reference = (
            self.reference_df.filter(ref_key.isNotNull())
            .select(ref_key.alias(key))
            .distinct()
            .select(key, F.hash(key).bitwiseAND(F.lit(0)).alias(pad), F.lit(True).alias(found))
        )
        wanted_pad = F.when(wanted.isNotNull(), F.lit(0)).otherwise(context.spread + 1)
        df = df.join(reference, (wanted == F.col(key)) & (wanted_pad == F.col(pad)), "left")
        return df, context.alive & F.col(found).isNull()
