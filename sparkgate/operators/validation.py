"""Validation outcomes: per-rule counts, summary, and the threshold gate."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from sparkgate.errors import ValidationError
from sparkgate.operators.ladder import (
    RULE_COL,
    label_rows,
    rejected_rows,
    surviving_rows,
)
from sparkgate.operators.rules import ValidationRule
from sparkgate.sources.staging import StagingArea

REJECTED_COL = "__rejected__"

# Fixed value: message of a rule result.
RESULT_MESSAGE = "{failed} record(s) failed rule '{rule_name}'"


@dataclass
class RuleResult:
    """Outcome of one rule."""

    rule_name: str
    passed: bool
    records_failed: int
    error_column: str
    error_message: str


@dataclass
class ValidationResult:
    """Outcome of a rule list over a frame."""

    total_records: int
    records_passed: int
    records_failed: int
    failure_ratio: float
    rule_results: list[RuleResult] = field(default_factory=list)
    valid_df: DataFrame | None = None
    invalid_df: DataFrame | None = None

    @property
    def passed(self) -> bool:
        """No record failed."""
        return self.records_failed == 0


def _rule_result(rule: ValidationRule, failed: int) -> RuleResult:
    return RuleResult(
        rule_name=rule.rule_name,
        passed=failed == 0,
        records_failed=failed,
        error_column=rule.rule_name.rpartition(":")[2],
        error_message=RESULT_MESSAGE.format(failed=failed, rule_name=rule.rule_name),
    )


class DataQualityValidator:
    """Applies rules in order; each judges only what the earlier ones passed.

    look_ahead is for frames that read stored rows, see label_rows. With a staging area the
    labelled frame is written there once, and counts, valid and invalid
    rows are all read back from it. Without one the two frames stay lazy, and each action on them
    evaluates the rules again.
    """

    def __init__(
        self,
        rules: Sequence[ValidationRule],
        job_logger: logging.Logger | None = None,
        *,
        order_by: Sequence[str] = (),
        look_ahead: bool = False,
        staging: StagingArea | None = None,
    ) -> None:
        self._rules = list(rules)
        self._log = job_logger or logging.getLogger(__name__)
        self._order_by = order_by
        self._look_ahead = look_ahead
        self._staging = staging

    def validate(self, df: DataFrame) -> ValidationResult:
        labelled = label_rows(
            df,
            self._rules,
            order_by=self._order_by,
            look_ahead=self._look_ahead,
            staging=self._staging,
        )
        if self._staging is None:
            valid, invalid = surviving_rows(labelled), rejected_rows(labelled, self._rules)
        else:
            # Split by directory, so that neither reader touches the other's files.
            staged = self._staging.write(
                labelled.withColumn(REJECTED_COL, F.col(RULE_COL).isNotNull()),
                "labelled",
                partition_by=[REJECTED_COL],
            )
            rejected = F.col(REJECTED_COL)
            valid = surviving_rows(staged.filter(~rejected).drop(REJECTED_COL))
            invalid = rejected_rows(staged.filter(rejected).drop(REJECTED_COL), self._rules)
            labelled = staged

        # One row per rule at most, plus one for the survivors.
        counts = {
            row[RULE_COL]: row["n"]
            for row in labelled.groupBy(RULE_COL).agg(F.count(F.lit(1)).alias("n")).collect()
        }
        total = sum(counts.values())
        failed = total - counts.get(None, 0)
        result = ValidationResult(
            total_records=total,
            records_passed=total - failed,
            records_failed=failed,
            failure_ratio=failed / total if total else 0.0,
            rule_results=[
                _rule_result(rule, counts.get(place, 0)) for place, rule in enumerate(self._rules)
            ],
            valid_df=valid,
            invalid_df=invalid,
        )
        self._log.info(
            "validation: %d of %d record(s) rejected", result.records_failed, result.total_records
        )
        return result


def rule_results(labelled: DataFrame, rules: Sequence[ValidationRule]) -> DataFrame:
    """One row per rule, in a frame: name, passed, failed count, column and message."""
    spark = labelled.sparkSession
    listed = spark.createDataFrame(
        [(place, r.rule_name, r.rule_name.rpartition(":")[2]) for place, r in enumerate(rules)],
        "place int, rule_name string, error_column string",
    )
    counts = (
        labelled.filter(F.col(RULE_COL).isNotNull())
        .groupBy(F.col(RULE_COL).alias("place"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    failed = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return listed.join(counts, "place", "left").select(
        "rule_name",
        (failed == 0).alias("passed"),
        failed.alias("records_failed"),
        "error_column",
        F.format_string(
            RESULT_MESSAGE.format(failed="%d", rule_name="%s"), failed, "rule_name"
        ).alias("error_message"),
    )


def validation_summary(labelled: DataFrame) -> DataFrame:
    """One row: total, passed, failed, ratio."""
    total = F.count(F.lit(1))
    failed = F.count(F.col(RULE_COL))
    return labelled.agg(
        total.alias("total_records"),
        (total - failed).alias("records_passed"),
        failed.alias("records_failed"),
        F.when(total > 0, failed / total).otherwise(F.lit(0.0)).alias("failure_ratio"),
    )


def check_threshold(result: ValidationResult, limit: float) -> None:
    """Raise when the reject ratio is above the limit; equality passes."""
    if result.failure_ratio > limit:
        raise ValidationError(
            f"reject ratio {result.failure_ratio:.2%} is above the limit {limit:.2%}; "
            "the target table is left as it was",
            failure_ratio=result.failure_ratio,
        )
