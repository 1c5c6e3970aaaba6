"""Small frames shared by the tests of the training-data operators."""

from __future__ import annotations

import os

import pytest
from llm_frames import documents

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def given(spark):
    """A function that reads one of the smallest tables."""
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables not at hand")
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and letters outside ASCII."""
    long = " ".join(f"w{n % 5000}" for n in range(40_000))
    return documents(
        spark,
        [
            (1, None, None), (2, "", "en"), (3, "  \t\n ", "en"), (4, long, "en"), (5, long, "de"),
            (6, "one two three", "en"), (6, "one two three", "en"), (7, "one  two\tthree", None),
            (None, "one two three", "en"), (None, None, None), (8, "a", "fr"), (9, "123 !!", "de"),
            (10, "𝔘𝔫𝔦 Ⱥ ΟΔΟΣ İ   ﬁ ñandú 漢字 🙂", "es"), (11, "x" * 3000, "en"),
        ],
    )


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])
