"""Every registered query against its SQL equivalent, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__
from oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = __spark_entry__._oracle.build()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not at hand")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(SQL) == set(__spark_entry__.QUERIES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert differences(__spark_entry__.queries()[name](spark, SF_DIR), duck, SQL[name]) == ""
