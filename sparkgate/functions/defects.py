"""Deterministic defect injection, for exercising rules on clean tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame


def inject_defects(
    df: DataFrame,
    key: str,
    edits: Mapping[str, Sequence[tuple[int, Column]]],
    duplicate_every: int | None = None,
) -> DataFrame:
    """Spoil chosen rows of df and leave all others as they are.

    edits maps a column to ``(n, value)`` pairs: where ``key % n == 0`` the column becomes value,
    the first matching pair winning. All edits read the unspoiled key. With duplicate_every, rows
    with ``key % duplicate_every == 0`` occur once more.
    """
    number = F.col(key)

    def spoiled(name: str) -> Column:
        value = F.col(name)
        for every, bad in reversed(edits.get(name, ())):
            value = F.when(number % every == 0, bad).otherwise(value)
        return value.alias(name)

    def spoil(rows: DataFrame) -> DataFrame:
        return rows.select([spoiled(name) for name in rows.columns])

    out = spoil(df)
    if duplicate_every is not None:
        out = out.unionByName(spoil(df.filter(number % duplicate_every == 0)))
    return out
