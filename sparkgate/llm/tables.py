"""Helpers shared by the operators: reading, staging, and joins that stay balanced."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from sparkgate.sources.staging import StagingArea

# A hot key's rows are counted in this many parts before the parts are summed.
SALTS = 256
# A group's rows meet its representative in slices of about so many rows.
SLICE_ROWS = 500
# Key lists are broadcast up to this measured size; larger ones are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """df computed once, kept as Parquet in the shared checkpoint folder, and read back.

    Frames built on it stay lazy, so the folder outlives the call; it goes with the staging scope
    around it, or with the checkpoint folder of the session.
    """
    return StagingArea(df.sparkSession, "llm").write(df, name)


class Scratch(StagingArea):
    """Intermediate tables of one operator, in one folder, each dropped when it is done with."""

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """df computed once, kept under that name until it is dropped."""
        return self.write(df, name)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a function over a task's batches, which hands memory it has freed back to the system.

    Workers wait for their next task for a while, beside the executor's own memory. What they hold on
    to then, for lack of whole free pages, adds up.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def private_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder that nothing else uses."""
    return f"{StagingArea(spark, 'llm').path}/{name}"


def salt(*columns: str, salts: int = SALTS) -> Column:
    """A number below salts taken from the row's content."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def repeated_groups(
    rows: DataFrame, keys: Sequence[str], id_col: str, *, largest: bool = False
) -> DataFrame:
    """Of keys with more than one row: keys, the row's salt, keep_id and group_size.

    rows must hold a column salt. A key has a row for each of its salts, so that a join on keys and
    salt spreads a hot key over that many tasks. Rows are combined map-side per key and salt.
    """
    keep = F.max if largest else F.min
    parts = rows.groupBy(*keys, "salt").agg(
        keep(id_col).alias("part_id"), F.count(F.lit(1)).alias("part_rows")
    )
    whole = parts.groupBy(*keys).agg(
        keep("part_id").alias("keep_id"), F.sum("part_rows").alias("group_size")
    )
    return parts.select(*keys, "salt").join(whole.filter("group_size > 1"), list(keys))


def narrow_enough(staged: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The staged frame, marked for broadcast if its counted rows fit under the limit."""
    return F.broadcast(staged) if staged.count() * row_bytes <= limit else staged
