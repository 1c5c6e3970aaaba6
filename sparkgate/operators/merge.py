"""MERGE as a pure function over two frames: matched rows are overwritten, others inserted.

Every target column is overwritten from the source, so the merged table is simply the target rows
no source key matches, plus the source. That takes an anti join on the keys alone: with few source
rows Catalyst broadcasts their keys and the target is not shuffled, and a skewed target side can
still be split at run time, which a full outer join does not allow.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from sparkgate.errors import DuplicateKeyError
from sparkgate.operators.sieve import KeySieve
from sparkgate.operators.skew import quoted

# A delivery's keys are covered by so many ranges at most.
KEY_RANGES = 32

ACTION_COL = "__action__"
_MAYBE = "__maybe__"
INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def unmatched_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], sieve: KeySieve | None = None
) -> DataFrame:
    """Target rows no source row has the keys of; a null key matches nothing.

    With a sieve of the source's keys, rows that it rules out stay where they are.
    """
    if sieve is not None:
        tagged = sieve.tag(target, keys, "__sieve", _MAYBE)
        ruled_out = tagged.filter(~F.col(_MAYBE)).select(*quoted(target.columns))
        return ruled_out.unionByName(unmatched_rows(tagged.filter(_MAYBE).drop(_MAYBE), source, keys))
    return target.join(source.select(*quoted(keys)), list(keys), "left_anti").select(*quoted(target.columns))


def matched_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], sieve: KeySieve | None = None
) -> DataFrame:
    """Target rows a source row has the keys of; rows that the sieve rules out are not shuffled."""
    if sieve is not None:
        target = sieve.tag(target, keys, "__sieve", _MAYBE).filter(_MAYBE).drop(_MAYBE)
    return target.join(source.select(*quoted(keys)), list(keys), "left_semi")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the merge. Source keys must be unique, and columns as in the target."""
    return unmatched_rows(target, source, keys).unionByName(source.select(*quoted(target.columns)))


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As merge_rows, with ``__action__`` telling what the merge did to each row."""
    known = target.select(*quoted(keys)).withColumn("__known__", F.lit(True))
    written = (
        source.select(*quoted(target.columns))
        .join(known, list(keys), "left")
        .withColumn(ACTION_COL, F.when(F.col("__known__"), UPDATE).otherwise(INSERT))
        .select(*quoted(target.columns), ACTION_COL)
    )
    kept = unmatched_rows(target, source, keys).withColumn(ACTION_COL, F.lit(UNCHANGED))
    return kept.unionByName(written)


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows_inserted, rows_updated, rows_unchanged. Only keys are read."""
    matched = (
        target.select(*quoted(keys)).withColumn("__side__", F.lit(1))
        .unionAll(source.select(*quoted(keys)).withColumn("__side__", F.lit(2)))
        .groupBy(*quoted(keys))
        .agg(
            F.count_if(F.col("__side__") == 1).alias("old"),
            F.count_if(F.col("__side__") == 2).alias("new"),
        )
    )
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(f"`{key}`").isNull()
    both = ~null_key & (F.col("old") > 0) & (F.col("new") > 0)
    return matched.agg(
        F.coalesce(F.sum(F.when(~both, F.col("new"))), F.lit(0)).alias("rows_inserted"),
        F.coalesce(F.sum(F.when(both, F.col("new"))), F.lit(0)).alias("rows_updated"),
        F.coalesce(F.sum(F.when(~both, F.col("old"))), F.lit(0)).alias("rows_unchanged"),
    )


def touched_partitions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partition_cols: Sequence[str]
) -> DataFrame:
    """Distinct partitions of the target that hold rows the source overwrites.

    Keys decide, not partitions: a row whose partition column changed is found where it was.
    """
    return (
        target.select(*quoted(dict.fromkeys([*keys, *partition_cols])))
        .join(source.select(*quoted(keys)), list(keys), "left_semi")
        .select(*quoted(partition_cols))
        .distinct()
    )


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice. Counts are combined map-side, so hot keys are harmless."""
    twice = source.groupBy(*quoted(keys)).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    for key in keys:
        twice = twice.filter(F.col(f"`{key}`").isNotNull())
    example = twice.first()
    if example is not None:
        found = ", ".join(f"{key}={example[key]!r}" for key in keys)
        raise DuplicateKeyError(f"source holds {example['n']} rows with {found}")


def key_ranges(source: DataFrame, key: str, most: int = KEY_RANGES) -> list[tuple]:
    """(least, greatest) key of each of up to most stretches of the source's keys, in order.

    A filter on them lets a scan of the target skip the row groups that hold no such key. Keys that
    are no numbers are covered by one range. Only the ranges reach the driver.
    """
    column = F.col(f"`{key}`")
    known = source.filter(column.isNotNull())
    stretch = F.lit(0)
    if isinstance(source.schema[key].dataType, T.NumericType):
        cuts = known.agg(F.percentile_approx(column, [n / most for n in range(1, most)]).alias("cuts")).first()["cuts"]
        bounds = sorted(set(cuts or []))
        if bounds:
            stretch = F.size(F.filter(F.array(*[F.lit(bound) for bound in bounds]), lambda bound: column > bound))
    rows = known.groupBy(stretch.alias("stretch")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return sorted((row["low"], row["high"]) for row in rows.collect())


def within_ranges(key: str, ranges: Sequence[tuple]) -> Column:
    """Whether a key lies in one of the ranges; in none of none."""
    inside = F.lit(False)
    for low, high in ranges:
        inside = inside | F.col(f"`{key}`").between(low, high)
    return inside
