"""Run parameters: required, non-blank, and checked once at the edge."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from sparkgate.errors import ConfigurationError

# Argument names a run is started with.
REQUIRED_ARGS = (
    "JOB_NAME",
    "RAW_BUCKET",
    "PROCESSED_BUCKET",
    "QUARANTINE_BUCKET",
    "ARCHIVE_BUCKET",
    "ENVIRONMENT",
)
DEFAULT_EXECUTION_ID = "local"
DEFAULT_DATABASE = "sparkgate"
DEFAULT_MAX_QUARANTINE_RATIO = 1.0


def clean_bucket(value: str) -> str:
    """Bucket name without scheme and trailing slashes; a local directory stays a path."""
    return value.strip().removeprefix("s3://").rstrip("/")


def _root(bucket: str) -> str:
    return bucket if bucket.startswith("/") or "://" in bucket else f"s3://{bucket}"


@dataclass(frozen=True)
class StorageSettings:
    """Where a run reads from and writes to."""

    raw_bucket: str
    processed_bucket: str
    quarantine_bucket: str
    archive_bucket: str

    @property
    def incoming_path(self) -> str:
        return f"{_root(self.raw_bucket)}/incoming/"

    @property
    def quarantine_base_path(self) -> str:
        return _root(self.quarantine_bucket)

    @property
    def archive_path(self) -> str:
        return _root(self.archive_bucket)

    @property
    def metrics_path(self) -> str:
        return f"{_root(self.processed_bucket)}/run_metrics/"

    @property
    def events_path(self) -> str:
        return f"{_root(self.processed_bucket)}/run_events/"

    def table_path(self, table: str) -> str:
        return f"{_root(self.processed_bucket)}/tables/{table}/"


@dataclass(frozen=True)
class RunSettings:
    """Everything a job needs to know apart from its data."""

    job_name: str
    environment: str
    storage: StorageSettings
    execution_id: str = DEFAULT_EXECUTION_ID
    max_quarantine_ratio: float = DEFAULT_MAX_QUARANTINE_RATIO
    database: str = field(default=DEFAULT_DATABASE)


def settings_from_args(args: Mapping[str, str]) -> RunSettings:
    """Build RunSettings from string arguments, naming the offending argument on failure."""
    for name in REQUIRED_ARGS:
        if not str(args.get(name) or "").strip():
            raise ConfigurationError(f"required argument {name} is missing or blank")

    raw_limit = args.get("MAX_QUARANTINE_RATIO", DEFAULT_MAX_QUARANTINE_RATIO)
    try:
        limit = float(raw_limit)
    except (TypeError, ValueError):
        raise ConfigurationError(f"MAX_QUARANTINE_RATIO is not a number: {raw_limit!r}") from None
    if not 0.0 <= limit <= 1.0:
        raise ConfigurationError(f"MAX_QUARANTINE_RATIO must lie in [0, 1], got {limit}")

    return RunSettings(
        job_name=args["JOB_NAME"],
        environment=args["ENVIRONMENT"],
        storage=StorageSettings(
            raw_bucket=clean_bucket(args["RAW_BUCKET"]),
            processed_bucket=clean_bucket(args["PROCESSED_BUCKET"]),
            quarantine_bucket=clean_bucket(args["QUARANTINE_BUCKET"]),
            archive_bucket=clean_bucket(args["ARCHIVE_BUCKET"]),
        ),
        execution_id=str(args.get("EXECUTION_ID") or "").strip() or DEFAULT_EXECUTION_ID,
        max_quarantine_ratio=limit,
        database=args.get("DATABASE", DEFAULT_DATABASE),
    )
