"""Catalog registration: a table under a name of its own, with the schema its files have now."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.schemas import raw_schema
from sparkgate.sources import hadoop
from sparkgate.sources.tables import Table, load_table, save_layout, sql_names

DRIFT_SCHEMA = "column string, change string, data_type string"
ADDED, GONE, RETYPED = "added", "gone", "type changed"


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Create or refresh the view ``database.table`` over the table at path.

    The view names the table's columns; it is replaced in one step, so readers meet the earlier
    columns or the new ones. Merges need no registration again, for the view reads the table.
    """
    database, _, table = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    found = load_table(spark, path)
    view = ".".join(sql_names([part]) for part in (database, table) if part)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {sql_names(found.schema.fieldNames())} FROM {found.name}")


def schema_drift(spark: SparkSession, path: str) -> DataFrame:
    """Columns in which the table's files differ from what the catalog knows: column, change, data_type.

    The footers of all files are read, by tasks. A column that some file has and the catalog has
    not is added; one that no file has any more is gone; one whose type differs is told as such.
    """
    table = load_table(spark, path)
    known = {field.name: field.dataType for field in raw_schema(table.schema).fields}
    there = _file_columns(spark, table)
    rows = []
    if there is not None:
        rows += [(name, ADDED, kind.simpleString()) for name, kind in there.items() if name not in known]
        rows += [(name, GONE, kind.simpleString()) for name, kind in known.items() if name not in there]
        rows += [
            (name, RETYPED, kind.simpleString()) for name, kind in there.items() if name in known and known[name] != kind
        ]
    return spark.createDataFrame(sorted(rows), DRIFT_SCHEMA)


def _file_columns(spark: SparkSession, table: Table) -> dict[str, T.DataType] | None:
    """Columns of the files and their partitions, as the catalog types partitions; None without files."""
    if not hadoop.exists(spark, table.data_path):
        return None
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    files = reader.format("parquet").option("pathGlobFilter", "*.parquet")
    if spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet"
    ).load(table.data_path).select("path").isEmpty():
        return None
    columns = {field.name: field.dataType for field in files.load(table.data_path).schema.fields}
    return columns | {name: table.schema[name].dataType for name in table.partition_cols}


def follow_schema(spark: SparkSession, path: str) -> DataFrame:
    """Let the catalog follow the table's files; the differences there were, see schema_drift.

    New columns are added, at the end of those that are no partitions. Columns that are gone stay,
    and read as null; changed types stay as well. Both are left to be told as events.
    """
    drift = schema_drift(spark, path)
    added = [(row["column"], row["data_type"]) for row in drift.filter(F.col("change") == ADDED).collect()]
    if added:
        table = load_table(spark, path)
        columns = ", ".join(f"{sql_names([name])} {kind}" for name, kind in added)
        spark.sql(f"ALTER TABLE {table.name} ADD COLUMNS ({columns})")
        fresh = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in added]
        schema = T.StructType([*table.schema.fields, *fresh])
        save_layout(spark, Table(table.path, schema, table.partition_cols, table.keys, table.buckets, table.history))
    return drift
