"""Sieves: which rows cannot have a listed key, told without shuffling rows.

A list of keys too long to broadcast is boiled down to one bit per key, at the place of its hash,
and these bits are broadcast. A row whose bit is not set has none of the listed keys for certain and
stays where it is. The others, those with a listed key and some that share a bit with one, are
shuffled, and an exact join or window decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from sparkgate.sources.staging import StagingArea

# Bits per listed key, of which so one in eight at most is set, and the bits of the largest sieve:
# 16 MB, twice that as broadcast rows. With more keys than fit, more rows are shuffled.
KEY_BITS = 8
MOST_BITS = 1 << 27
# A row of a sieve holds so many longs, and so many bits.
_LONGS = 8
_STRETCH = 512
_PLAIN = (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _plain(kind: T.DataType) -> bool:
    """Whether equal values of the type have equal hashes; not so for text under a collation."""
    return isinstance(kind, _PLAIN) or kind == T.StringType()


def can_sieve(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> bool:
    """Whether both sides' keys are of the same plain types, so that equal keys share a bit."""
    return all(_plain(df.schema[k].dataType) and df.schema[k].dataType == listed.schema[k].dataType for k in keys)


@dataclass(frozen=True)
class KeySieve:
    """The stored bits of a list of keys, in stretches, and how many there are."""

    stretches: DataFrame
    bits: int

    def tag(self, df: DataFrame, keys: Sequence[str], prefix: str, flag: str) -> DataFrame:
        """df plus a boolean: its key may be among the listed ones. False is certain."""
        stretch, longs = f"{prefix}_stretch", f"{prefix}_longs"
        stored = self.stretches.select(F.col("stretch").alias(stretch), F.col("longs").alias(longs))
        place = _place(keys, self.bits)
        tagged = df.join(F.broadcast(stored), _stretch_of(place) == F.col(stretch), "left")
        within = _within(place)
        bit = F.getbit(F.get(F.col(longs), F.shiftright(within, 6)), within.bitwiseAND(F.lit(63)))
        return tagged.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop(stretch, longs)


def key_sieve(listed: DataFrame, keys: Sequence[str], count: int, staging: StagingArea, name: str) -> KeySieve:
    """The sieve of count listed keys, stored under name. Keys are shuffled by stretch, once each."""
    bits = min(MOST_BITS, max(_STRETCH, 1 << (count * KEY_BITS - 1).bit_length()))
    place = _place(keys, bits)
    placed = listed.select(_stretch_of(place).alias("stretch"), _within(place).alias("within")).repartition("stretch")
    within = F.col("within")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), within.bitwiseAND(F.lit(63)))
    longs = [
        F.coalesce(F.bit_or(F.when(F.shiftright(within, 6) == n, mask)), F.lit(0).cast("long")) for n in range(_LONGS)
    ]
    return KeySieve(staging.write(placed.groupBy("stretch").agg(F.array(*longs).alias("longs")), name), bits)


def _place(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{key}`") for key in keys]), F.lit(bits).cast("long"))


def _stretch_of(place: Column) -> Column:
    return F.shiftright(place, _STRETCH.bit_length() - 1)


def _within(place: Column) -> Column:
    return place.bitwiseAND(F.lit(_STRETCH - 1)).cast("int")
