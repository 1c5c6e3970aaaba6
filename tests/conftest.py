"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("sparkgate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def storage_args(tmp_path):
    """Arguments of a run whose buckets are local folders."""
    return {
        "JOB_NAME": "test-job",
        "RAW_BUCKET": str(tmp_path / "raw"),
        "PROCESSED_BUCKET": str(tmp_path / "processed"),
        "QUARANTINE_BUCKET": str(tmp_path / "rejects"),
        "ARCHIVE_BUCKET": str(tmp_path / "archive"),
        "ENVIRONMENT": "test",
    }
