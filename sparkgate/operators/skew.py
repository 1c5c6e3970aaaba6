"""Keeping rows where they are, and groups bounded.

Over stored rows, rules over keys can look at the keys first: a narrow aggregate, combined
map-side, finds the few that can matter. If these are few enough to broadcast, whole rows need not
be shuffled at all. If not, rows are shuffled by key, with hot keys split and failed rows spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from sparkgate.operators.key_bitmap import key_bitmaps, orphan_rows
from sparkgate.sources.staging import StagingArea

# Rows of one group that need not stay together are dealt into this many subgroups.
SPREAD_WIDTH = 1024
# A key counted to have no more rows than this is not worth splitting.
DEFAULT_HOT_ROWS = 1_000_000
# Keys are broadcast up to this size, as text plus some room per row.
BROADCAST_BYTES = 8 << 20
_ROW_BYTES = 32


def _comparable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return _comparable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_comparable(f.dataType) for f in data_type.fields)
    return True


def comparable_columns(df: DataFrame) -> list[str]:
    """Columns that can be ordered and hashed: all without maps and variants."""
    return [f.name for f in df.schema.fields if _comparable(f.dataType)]


def quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def spread(df: DataFrame) -> Column:
    """Subgroup number of a row.

    It mixes in the input partition, so that identical copies part too. Unlike a row counter, the
    partition of a row is the same when a lost task runs again after a shuffle.
    """
    columns = quoted(comparable_columns(df))
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(SPREAD_WIDTH)).cast("int")


def repeated_keys(df: DataFrame, keys: Sequence[str], staging: StagingArea, name: str) -> DataFrame:
    """Keys with more than one row, and their row count n. Null keys count as equal."""
    counted = df.groupBy(*quoted(keys)).agg(F.count(F.lit(1)).alias("n"))
    return staging.write(counted.filter(F.col("n") > 1), name)


def missing_keys(
    df: DataFrame, key: str, reference: DataFrame, ref_key: str, staging: StagingArea, name: str,
    *, dense_keys: bool = False,
) -> DataFrame:
    """Distinct keys of df, null aside, that the reference column does not hold."""
    wanted = df.select(F.col(f"`{key}`").alias(key)).filter(F.col(f"`{key}`").isNotNull())
    if dense_keys:
        return staging.write(orphan_rows(wanted.distinct(), key, key_bitmaps(reference, ref_key)), name)
    known = reference.select(F.col(f"`{ref_key}`").alias(key))
    return staging.write(wanted.distinct().join(known, key, "left_anti"), name)


def key_width(keys: Sequence[str]) -> Column:
    """About how much one key takes in a broadcast."""
    return reduce(
        lambda total, key: total + F.coalesce(F.octet_length(key.cast("string")), F.lit(0)),
        quoted(keys),
        F.lit(_ROW_BYTES),
    )


def tag_keys(
    df: DataFrame, keys: Sequence[str], listed: DataFrame, prefix: str, flag: str
) -> DataFrame:
    """df plus a boolean: its key is among the listed ones, which are broadcast.

    Only for keys whose size has been checked, see key_width.
    """
    names = [f"{prefix}_key{n}" for n in range(len(keys))]
    small = listed.select(
        *[key.alias(name) for key, name in zip(quoted(keys), names)], F.lit(True).alias(flag)
    )
    same = reduce(
        lambda found, pair: found & pair[0].eqNullSafe(F.col(pair[1])),
        zip(quoted(keys), names),
        F.lit(True),
    )
    tagged = df.join(F.broadcast(small), same, "left")
    return tagged.withColumn(flag, F.col(flag).isNotNull()).drop(*names)
