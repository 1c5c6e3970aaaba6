"""Quarantine: rejected rows kept with their reason, in folders per table, run day and run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.functions.names import safe_execution_id
from sparkgate.sources import hadoop


def quarantine_path(base_path: str, table_name: str, execution_id: str, run_date: str) -> str:
    """Folder of one run's rejects.

    The day level is called run_date: rejected rows may have a date column of their own, which a
    folder level named date would shadow on reading.
    """
    return (
        f"{base_path.rstrip('/')}/table={table_name}/run_date={run_date}"
        f"/execution_id={safe_execution_id(execution_id)}"
    )


def write_to_quarantine(
    df: DataFrame,
    quarantine_base_path: str,
    table_name: str,
    execution_id: str,
    partition_date: str,
    *,
    replace: bool = False,
    rows: int | None = None,
) -> int:
    """Append df to its run's folder and return the row count; with no rows, write nothing.

    rows is their number, if known. Otherwise it is that by which the stored rows have grown. With
    replace, what the same run wrote before, on whatever day, goes first: a retried run then
    does not leave its rejects twice.
    """
    spark = df.sparkSession
    path = quarantine_path(quarantine_base_path, table_name, execution_id, partition_date)
    if replace:
        table_folder, _, run = path.rsplit("/", 2)
        for earlier_day in hadoop.child_names(spark, table_folder):
            hadoop.remove(spark, f"{table_folder}/{earlier_day}/{run}")
    if rows == 0 or rows is None and df.isEmpty():
        return 0
    if rows is None:
        before = spark.read.parquet(path).count() if hadoop.exists(spark, path) else 0
        df.write.mode("append").parquet(path)
        return spark.read.parquet(path).count() - before
    df.write.mode("append").parquet(path)
    return rows


def read_quarantine(spark: SparkSession, base_path: str, table_name: str) -> DataFrame:
    """All rejects of a table, with run_date and execution_id from the folders, ids as text."""
    base = base_path.rstrip("/")
    reader = spark.read.option("basePath", base).option("mergeSchema", "true")
    path = f"{base}/table={table_name}"
    # Spark guesses the types of folder values, and an id may look like a number.
    typed = {"table": T.StringType(), "execution_id": T.StringType(), "run_date": T.DateType()}
    found = reader.parquet(path).schema
    fields = [T.StructField(f.name, typed.get(f.name, f.dataType)) for f in found.fields]
    return reader.schema(T.StructType(fields)).parquet(path)
