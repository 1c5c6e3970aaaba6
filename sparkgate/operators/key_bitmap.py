"""Which keys a reference holds, as bitmaps: one row for each stretch of 32,768 integer keys.

For keys that lie close together, as counted ids do, that is thousands of times fewer rows than
there are keys, and so much less to shuffle or broadcast. Keys spread thinly over the whole range of
a long would take a bitmap of 4 kB each: use the plain join for those.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from sparkgate.errors import SchemaError

BUCKET_COL, BITS_COL = "__bucket__", "__bits__"
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def bucket_of(key: Column) -> Column:
    """The stretch a key lies in."""
    return F.bitmap_bucket_number(key.cast("long"))


def key_bitmaps(reference: DataFrame, column: str) -> DataFrame:
    """``__bucket__`` and ``__bits__`` of the column's keys; nulls are left out.

    Bitmaps are built map-side first, so no more than one per stretch and task is shuffled. They
    can be kept and put together with those of other rows, see merged_bitmaps.
    """
    kind = reference.schema[column].dataType
    if not isinstance(kind, _INTEGERS):
        raise SchemaError(f"bitmaps take integer keys; '{column}' is {kind.simpleString()}")
    key = F.col(f"`{column}`").cast("long")
    return (
        reference.filter(key.isNotNull())
        .groupBy(bucket_of(key).alias(BUCKET_COL))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(BITS_COL))
    )


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One bitmap per stretch, of several."""
    return bitmaps.groupBy(BUCKET_COL).agg(F.bitmap_or_agg(BITS_COL).alias(BITS_COL))


def key_count() -> Column:
    """Number of distinct keys, as an aggregate over merged bitmaps."""
    return F.coalesce(F.sum(F.bitmap_count(BITS_COL)), F.lit(0).cast("long"))


def holds(bits: Column, key: Column) -> Column:
    """Whether a stretch's bitmap holds the key; false without a bitmap or key."""
    place = F.bitmap_bit_position(key.cast("long"))
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def with_known(df: DataFrame, key: str, bitmaps: DataFrame, found: str) -> DataFrame:
    """df plus a boolean: the reference behind the bitmaps holds its key. A null key it never holds.

    Rows meet the bitmaps by stretch: small ones are broadcast by Spark, and adaptive execution
    splits hot stretches.
    """
    known = bitmaps.select(F.col(BUCKET_COL).alias(f"{found}_bucket"), F.col(BITS_COL).alias(f"{found}_bits"))
    column = F.col(f"`{key}`")
    joined = df.join(known, bucket_of(column) == F.col(f"{found}_bucket"), "left")
    return joined.withColumn(found, holds(F.col(f"{found}_bits"), column)).drop(f"{found}_bucket", f"{found}_bits")


def known_rows(df: DataFrame, key: str, bitmaps: DataFrame) -> DataFrame:
    """Rows whose key the reference holds: the semi join."""
    return with_known(df, key, bitmaps, "__known__").filter("__known__").drop("__known__")


def orphan_rows(df: DataFrame, key: str, bitmaps: DataFrame) -> DataFrame:
    """Rows whose key the reference does not hold, null keys among them: the anti join."""
    return with_known(df, key, bitmaps, "__known__").filter("NOT __known__").drop("__known__")
