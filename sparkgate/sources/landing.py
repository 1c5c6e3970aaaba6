"""Readers of landing files: CSV, JSON lines, and file listings. All read nullable columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.errors import StorageReadError
from sparkgate.schemas import raw_schema
from sparkgate.sources import hadoop

CSV_GLOB = "*.[cC][sS][vV]"
JSON_GLOB = "*.json"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, glob: str = CSV_GLOB
) -> DataFrame:
    """CSV files with a header; a malformed value reads as null.

    The glob keeps other file kinds in the same folder out. Columns are matched by position, as
    the header option does.
    """
    return _read(
        lambda: spark.read.option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", glob)
        .schema(raw_schema(schema))
        .csv(path),
        path,
    )


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, *, glob: str = JSON_GLOB
) -> DataFrame:
    """Newline-delimited JSON; an absent field reads as null."""
    return _read(
        lambda: spark.read.schema(raw_schema(schema)).option("pathGlobFilter", glob).json(path),
        path,
    )


def write_json_lines(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Newline-delimited JSON with explicit nulls."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def list_files(spark: SparkSession, path: str, wanted: Column | None = None) -> DataFrame:
    """Files under a folder and its subfolders: path, file_name, length, modification_time.

    wanted is a predicate on file_name. Files are listed from the file system's metadata, those of
    zero bytes too; names that begin with a dot or an underscore are left out, as Spark's readers
    do. An empty folder gives no rows.
    """
    if not hadoop.exists(spark, path):
        raise StorageReadError(f"cannot read {path}: no such path", location=path)
    rows = [
        (place, place.rpartition("/")[2], size, datetime.fromtimestamp(changed / 1000, timezone.utc))
        for place, size, changed in hadoop.files_below(spark, path)
        if place.rpartition("/")[2][0] not in "._"
    ]
    listed = spark.createDataFrame(
        rows, "path string, file_name string, length bigint, modification_time timestamp"
    )
    return listed if wanted is None else listed.filter(wanted)


def _read(load, path: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        raise StorageReadError(f"cannot read {path}: {error}", location=path) from error

