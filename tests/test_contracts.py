"""Schemas, run parameters and errors: contracts that need no session."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import types as T

from sparkgate import errors
from sparkgate.errors import ConfigurationError, SparkgateError, ValidationError
from sparkgate.schemas import (
    ORDER_ITEMS_SCHEMA,
    PARTITION_COLS,
    PRIMARY_KEYS,
    SCHEMA_REGISTRY,
    raw_schema,
    required_columns,
)
from sparkgate.settings import REQUIRED_ARGS, settings_from_args

ARGS = {name: f"value-of-{name}" for name in REQUIRED_ARGS}


def test_schemas_agree_with_keys_and_partitions():
    assert set(SCHEMA_REGISTRY) == set(PRIMARY_KEYS) == set(PARTITION_COLS)
    assert {t: len(s) for t, s in SCHEMA_REGISTRY.items()} == {
        "products": 4, "orders": 6, "order_items": 9}
    for name, schema in SCHEMA_REGISTRY.items():
        assert set(PRIMARY_KEYS[name]) <= set(required_columns(schema))
        assert set(PARTITION_COLS[name]) <= set(schema.fieldNames())
    assert PARTITION_COLS == {"products": [], "orders": ["date"], "order_items": ["date"]}


def test_raw_schema_only_relaxes_nulls():
    raw = raw_schema(ORDER_ITEMS_SCHEMA)
    assert raw.fieldNames() == ORDER_ITEMS_SCHEMA.fieldNames()
    assert all(f.nullable for f in raw)
    assert isinstance(raw["id"].dataType, T.LongType)
    assert ORDER_ITEMS_SCHEMA["days_since_prior_order"].nullable


@pytest.mark.parametrize("name", REQUIRED_ARGS)
@pytest.mark.parametrize("value", [None, "", "   "])
def test_required_arguments(name, value):
    with pytest.raises(ConfigurationError, match=name):
        settings_from_args({**ARGS, name: value})


def test_defaults_and_overrides():
    settings = settings_from_args(ARGS)
    assert settings.execution_id == "local"
    assert settings.max_quarantine_ratio == 1.0
    changed = settings_from_args(
        {**ARGS, "EXECUTION_ID": "arn:1", "MAX_QUARANTINE_RATIO": "0.1", "DATABASE": "d"})
    assert (changed.execution_id, changed.max_quarantine_ratio) == ("arn:1", 0.1)
    assert changed.database == "d"
    with pytest.raises(dataclasses.FrozenInstanceError):
        settings.environment = "x"


@pytest.mark.parametrize("limit", ["1.5", "-0.1", "many", "nan"])
def test_limit_must_be_a_ratio(limit):
    with pytest.raises(ConfigurationError, match="MAX_QUARANTINE_RATIO"):
        settings_from_args({**ARGS, "MAX_QUARANTINE_RATIO": limit})


def test_paths():
    storage = settings_from_args({**ARGS, "RAW_BUCKET": "s3://raw/", "PROCESSED_BUCKET": "done"}).storage
    assert storage.raw_bucket == "raw"
    assert storage.incoming_path == "s3://raw/incoming/"
    assert storage.table_path("orders") == "s3://done/tables/orders/"
    local = settings_from_args({**ARGS, "QUARANTINE_BUCKET": "/tmp/q/"}).storage
    assert local.quarantine_base_path == "/tmp/q"


def test_error_families():
    kinds = [e for e in vars(errors).values() if isinstance(e, type) and issubclass(e, Exception)]
    assert all(issubclass(e, SparkgateError) for e in kinds)
    for kind in (errors.NullKeyError, errors.DuplicateKeyError):
        assert issubclass(kind, ValidationError)
    for kind in (errors.StorageReadError, errors.StorageWriteError):
        assert kind("x", location="here").location == "here"
        assert kind("x").location == ""
    assert issubclass(errors.TableMergeError, errors.JobError)
    assert ValidationError("x", failure_ratio=0.12).failure_ratio == 0.12
    assert ValidationError("x").failure_ratio == 0.0
