"""Staging: a frame written once to the shared checkpoint folder and read back.

It cuts lineage durably. Unlike a cached frame it survives lost executors, takes no executor
memory, and is columnar, so later readers prune columns and directories.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from sparkgate.errors import ConfigurationError
from sparkgate.sources import hadoop


def staging_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one in local mode if it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ConfigurationError("spark.checkpoint.dir must name a folder all executors share")
    return tempfile.gettempdir()


_open_scope: ContextVar[list[StagingArea] | None] = ContextVar("open_scope", default=None)


@contextmanager
def staging_scope() -> Iterator[None]:
    """Clears at its end every staging area made inside, in this thread.

    Operators return frames that read what they have staged, so that must stay until the frame has
    been used: use it inside the scope, for instance write it. Without a scope staged tables lie in
    the checkpoint folder until that goes.
    """
    areas: list[StagingArea] = []
    token = _open_scope.set(areas)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for area in areas:
            area.clear()


class StagingArea:
    """A private folder for the intermediate tables of one run."""

    def __init__(self, spark: SparkSession, label: str = "run") -> None:
        self._spark = spark
        self.path = f"{staging_root(spark)}/sparkgate/{label}-{uuid.uuid4().hex}"
        scope = _open_scope.get()
        if scope is not None:
            scope.append(self)

    def write(
        self, df: DataFrame, name: str, *, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write df under name and return it as read back."""
        location = f"{self.path}/{name}"
        df.write.partitionBy(*partition_by).parquet(location)
        return self._spark.read.schema(df.schema).parquet(location).select(*[f"`{c}`" for c in df.columns])

    def drop(self, *names: str) -> None:
        """Delete these tables, where they exist. Frames read from them must not be used any more."""
        for name in names:
            hadoop.remove(self._spark, f"{self.path}/{name}")

    def clear(self) -> None:
        """Delete the folder. Frames read from it must not be used any more."""
        hadoop.remove(self._spark, self.path)

    def __enter__(self) -> StagingArea:
        return self

    def __exit__(self, *_: object) -> None:
        self.clear()
