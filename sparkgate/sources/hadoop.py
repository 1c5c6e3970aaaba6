"""A thin reach into the Hadoop file system Spark itself uses, for metadata only."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, location: str) -> tuple[Any, Any]:
    """(file system, path) of a location, whatever its scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    fs, path = file_system(spark, location)
    return fs.exists(path)


def child_names(spark: SparkSession, location: str) -> list[str]:
    """Names directly under a directory; none when it does not exist."""
    fs, path = file_system(spark, location)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def files_below(spark: SparkSession, location: str) -> list[tuple[str, int, int]]:
    """(path, bytes, milliseconds of the last change) of all files under a folder, however deep."""
    fs, path = file_system(spark, location)
    found, left = [], fs.listFiles(path, True)
    while left.hasNext():
        status = left.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return found


def remove(spark: SparkSession, location: str) -> None:
    fs, path = file_system(spark, location)
    fs.delete(path, True)


def move(spark: SparkSession, source: str, destination: str) -> bool:
    """Copy one file, to another file system if need be, then delete it. False when refused."""
    source_fs, source_path = file_system(spark, source)
    target_fs, target_path = file_system(spark, destination)
    target_fs.mkdirs(target_path.getParent())
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        source_fs, source_path, target_fs, target_path, True, spark._jsc.hadoopConfiguration()
    )


def write_text(spark: SparkSession, location: str, text: str) -> None:
    """Write a small text file that appears whole or not at all; refuse to replace one."""
    folder, _, name = location.rpartition("/")
    # Readers of the folder skip names with a leading dot.
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    fs, draft_path = file_system(spark, draft)
    stream = fs.create(draft_path)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    _, path = file_system(spark, location)
    if fs.exists(path) or not fs.rename(draft_path, path):
        fs.delete(draft_path, False)
        raise FileExistsError(f"{location} exists already")


def read_text(spark: SparkSession, location: str) -> str:
    """Content of a small text file."""
    fs, path = file_system(spark, location)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
