"""Typed failures raised by jobs, sources and tables."""

from __future__ import annotations


class SparkgateError(Exception):
    """Base of every error this package raises on purpose."""


class ConfigurationError(SparkgateError):
    """A run parameter is missing, blank or out of range."""


class SchemaError(SparkgateError):
    """Rows do not fit the declared schema of their target table."""


class ValidationError(SparkgateError):
    """The reject ratio of a run passed its limit."""

    def __init__(self, message: str, failure_ratio: float = 0.0) -> None:
        super().__init__(message)
        self.failure_ratio = failure_ratio


class NullKeyError(ValidationError):
    """A key column holds nulls where none are allowed."""


class DuplicateKeyError(ValidationError):
    """A key occurs more than once where it must be unique."""


class StorageError(SparkgateError):
    """A read or write on a file system failed."""

    def __init__(self, message: str, location: str = "") -> None:
        super().__init__(message)
        self.location = location


class StorageReadError(StorageError):
    """Listing or reading files failed."""


class StorageWriteError(StorageError):
    """Writing or moving files failed."""


class JobError(SparkgateError):
    """A job step failed."""


class TableMergeError(JobError):
    """An upsert into a table failed; the table keeps its earlier version."""
