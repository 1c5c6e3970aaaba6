"""Incremental loading: new landing files start a run, progress is kept on success only."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkgate.plans.jobs import TableJob, run_table_job
from sparkgate.schemas import raw_schema
from sparkgate.settings import RunSettings
from sparkgate.sources import hadoop
from sparkgate.sources.excel import WORKBOOK_GLOB, parse_workbooks
from sparkgate.sources.landing import CSV_GLOB

# The columns Spark's binaryFile source gives.
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    glob: str = CSV_GLOB,
    archive_dir: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """CSV files as they arrive under path."""
    reader = (
        spark.readStream.schema(raw_schema(schema))
        .option("header", "true")
        .option("mode", "PERMISSIVE")
    )
    return _files(reader, glob, archive_dir, files_per_batch).csv(path)


def stream_workbooks(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    wanted: Column | None = None,
    archive_dir: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Workbooks as they arrive under path and its subfolders; wanted is a predicate on file_name."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
    reader = reader.option("recursiveFileLookup", "true")
    files = _files(reader, WORKBOOK_GLOB, archive_dir, files_per_batch).load(path)
    files = files.select("content", F.substring_index("path", "/", -1).alias("file_name"))
    return parse_workbooks(files if wanted is None else files.filter(wanted), schema)


def _files(reader, glob: str, archive_dir: str | None, files_per_batch: int):
    reader = reader.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch)
    if archive_dir is not None:
        # Spark moves the files of a batch once a later batch has run.
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader


def _stream_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The id that Spark gave the stream of this checkpoint, which restarts keep."""
    return json.loads(hadoop.read_text(spark, f"{checkpoint_path.rstrip('/')}/metadata"))["id"]


def start_table_load(
    spark: SparkSession,
    source: DataFrame,
    job: TableJob | Callable[[], TableJob],
    settings: RunSettings,
    checkpoint_path: str,
    **options,
) -> StreamingQuery:
    """Run the table job on each batch of new files until all present ones are done.

    A batch that fails its gate raises; its files are then not marked done, and the next start
    replays the same batch. Replays change nothing twice: a batch whose merge was published is not
    loaded again and reports once, and rejects replace those of the same batch. Pass a function as
    job when its rules read a table that changes between batches, such as orders for order items.
    """

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        current = job() if callable(job) else job
        batch_settings = replace(
            settings, execution_id=f"{settings.execution_id}_batch_{batch_id}"
        )
        run_table_job(
            spark,
            current,
            batch_settings,
            lambda: batch,
            replace_quarantine=True,
            # A checkpoint that starts anew counts its batches anew, under another id.
            batch_id=f"{_stream_id(spark, checkpoint_path)}:{current.table}:{batch_id}",
            **options,
        )

    return (
        source.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
