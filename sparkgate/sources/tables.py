"""Parquet tables of Spark's catalog: create, read, upsert, version.

A table is an external catalog table over the files under its path. Any Spark program reads it by
name or as plain Parquet, see catalog.register_table for a name of one's own. Under the path::

    data/                 the table's files, in partition folders if any
    meta.json             schema and layout, from which the catalog entry is made where it is missing
    merges/<version>.json counts of each merge, and the batch it came from
    changes/              rows as they were before each merge, if the table keeps its history

A merge stores the new content of the partitions it touches, and then has Spark overwrite just
these, by dynamic partition overwrite. Rows match on keys alone, so a partition is touched if it
holds a matched row or receives one. If a run breaks off in between, the next merge finishes it
from what is stored; one that breaks off earlier leaves the table as it was. Where no row is
matched, rows are only appended; if that breaks off before it is published, the same delivery merges
to the same rows when it comes again. One writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.errors import NullKeyError, SchemaError, SparkgateError, TableMergeError
from sparkgate.functions.conform import conform
from sparkgate.operators.merge import key_ranges, matched_rows, require_unique, unmatched_rows, within_ranges
from sparkgate.operators.sieve import KeySieve, can_sieve, key_sieve
from sparkgate.operators.skew import quoted
from sparkgate.schemas import raw_schema, required_columns
from sparkgate.sources import hadoop
from sparkgate.sources.staging import StagingArea

# Where the catalog entries go; their files lie elsewhere.
DATABASE = "default"
VERSION_COL = "__version__"
ACTION_COL = "__action__"
_ROWS, _FILE = "__rows__", "__file__"
# From so many rows on, the keys of a delivery are boiled down to a sieve for its match.
SIEVE_ROWS = 200_000
_LEDGER_SCHEMA = (
    "version bigint, batch_id string, rows_inserted bigint, rows_updated bigint, rows_unchanged bigint, "
    "details map<string,bigint>"
)


@dataclass(frozen=True)
class MergeResult:
    """Row counts of one merge; unchanged rows are target rows no source row matched."""

    rows_inserted: int
    rows_updated: int
    rows_unchanged: int

    @property
    def total_affected(self) -> int:
        return self.rows_inserted + self.rows_updated + self.rows_unchanged


@dataclass(frozen=True)
class Table:
    """A table's place and layout."""

    path: str
    schema: T.StructType
    partition_cols: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    buckets: int = 0
    history: bool = False

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def name(self) -> str:
        """Its name in the catalog, made from its path."""
        last = re.sub(r"\W", "_", self.path.rpartition("/")[2]).lower()
        return f"`{DATABASE}`.`sparkgate_{last}_{hashlib.md5(self.path.encode()).hexdigest()[:12]}`"

    @property
    def insert_order(self) -> list[str]:
        """Columns as the catalog has them: those of partitions last."""
        data = [name for name in self.schema.fieldNames() if name not in self.partition_cols]
        return [*data, *self.partition_cols]

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table as it is now, in the catalog's order of columns."""
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)


def _clean(path: str) -> str:
    return path.rstrip("/")


def sql_names(names: Sequence[str]) -> str:
    """Column names as SQL text, parted by commas."""
    return ", ".join("`" + name.replace("`", "``") + "`" for name in names)


def text_literal(value: str) -> str:
    """A string as SQL text."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def table_exists(spark: SparkSession, path: str) -> bool:
    return hadoop.exists(spark, f"{_clean(path)}/meta.json")


def create_table_if_not_exists(
    spark: SparkSession,
    schema: T.StructType,
    path: str,
    partition_cols: Sequence[str] = (),
    *,
    keys: Sequence[str] = (),
    buckets: int = 0,
    history: bool = False,
) -> None:
    """Create an empty table at path as version 0; leave an existing one alone.

    With buckets, rows are dealt to so many files per partition by hash of keys, and merges by
    these keys do not shuffle the table. With history, earlier versions can be read.
    """
    if table_exists(spark, path):
        return
    for taken in (VERSION_COL, ACTION_COL, _ROWS, _FILE):
        if taken in schema.fieldNames():
            raise SchemaError(f"column name {taken!r} is taken by the table layout")
    if (buckets or history) and not keys:
        raise SchemaError("buckets and history need the table's keys")
    table = Table(_clean(path), schema, tuple(partition_cols), tuple(keys), buckets, history)
    save_layout(spark, table)
    _register(spark, table)


def save_layout(spark: SparkSession, table: Table) -> None:
    """Write the table's schema and layout beside its files."""
    meta = {
        "schema": table.schema.jsonValue(), "partition_cols": list(table.partition_cols),
        "keys": list(table.keys), "buckets": table.buckets, "history": table.history,
    }
    hadoop.remove(spark, f"{table.path}/meta.json")
    hadoop.write_text(spark, f"{table.path}/meta.json", json.dumps(meta))


def _register(spark: SparkSession, table: Table) -> None:
    """Make the catalog know the table, and the partitions there are."""
    ddl = f"CREATE TABLE IF NOT EXISTS {table.name} ({raw_schema(table.schema).toDDL()}) USING parquet"
    if table.partition_cols:
        ddl += f" PARTITIONED BY ({sql_names(table.partition_cols)})"
    if table.buckets:
        names = sql_names(table.keys)
        ddl += f" CLUSTERED BY ({names}) SORTED BY ({names}) INTO {table.buckets} BUCKETS"
    spark.sql(f"{ddl} LOCATION {text_literal(table.data_path)}")
    if table.partition_cols and hadoop.exists(spark, table.data_path):
        spark.catalog.recoverPartitions(table.name)


def load_table(spark: SparkSession, path: str) -> Table:
    """The table at path, made known to the catalog if it is not."""
    path = _clean(path)
    if not table_exists(spark, path):
        raise TableMergeError(f"no table at {path}")
    meta = json.loads(hadoop.read_text(spark, f"{path}/meta.json"))
    table = Table(
        path, T.StructType.fromJson(meta["schema"]), tuple(meta["partition_cols"]), tuple(meta["keys"]),
        meta["buckets"], meta["history"],
    )
    if not spark.catalog.tableExists(table.name):
        _register(spark, table)
    return table


# --- Versions -----------------------------------------------------------------------------------


def _merges(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(version, file name) of each merge, in order."""
    names = [n for n in hadoop.child_names(spark, f"{path}/merges") if n.endswith(".json")]
    return sorted((int(name.partition(".")[0].partition("-")[0]), name) for name in names)


def get_table_version(spark: SparkSession, path: str) -> int:
    """Number of the last merge; each merge adds one, and a new table is at 0."""
    path = _clean(path)
    if not table_exists(spark, path):
        raise TableMergeError(f"no table at {path}")
    merges = _merges(spark, path)
    return merges[-1][0] if merges else 0


def merge_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per merge: version, batch_id, row counts and details."""
    return spark.read.schema(_LEDGER_SCHEMA).json(f"{_clean(path)}/merges")


def published_batch(spark: SparkSession, path: str, batch_id: str) -> dict | None:
    """What the ledger says of a batch's merge; None if it was not published.

    A merge of the batch that broke off after its rows were stored is finished first.
    """
    path = _clean(path)
    if not table_exists(spark, path):
        return None
    _finish_pending(spark, load_table(spark, path))
    mark = f"-{_batch_mark(batch_id)}.json"
    for _, name in _merges(spark, path):
        if name.endswith(mark):
            return json.loads(hadoop.read_text(spark, f"{path}/merges/{name}"))
    return None


def _batch_mark(batch_id: str) -> str:
    return hashlib.md5(batch_id.encode()).hexdigest()


def _publish(spark: SparkSession, table: Table, entry: Mapping) -> None:
    mark = f"-{_batch_mark(entry['batch_id'])}" if entry["batch_id"] is not None else ""
    hadoop.write_text(spark, f"{table.path}/merges/{entry['version']:010d}{mark}.json", json.dumps(entry) + "\n")


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of the table now, or as of a version if the table keeps its history.

    Rows that merges have changed since are taken from the changes: as each was before the first
    merge after that version that changed it. Rows inserted since are left out.
    """
    table = load_table(spark, path)
    columns = quoted(table.schema.fieldNames())
    rows = table.rows(spark).select(*columns)
    latest = get_table_version(spark, path)
    if version is None or version == latest:
        return rows
    if not table.history or not 0 <= version < latest:
        raise TableMergeError(f"version {version} of {table.path} cannot be read")
    changes = spark.read.parquet(f"{table.path}/changes").filter(F.col(VERSION_COL) > version)
    before = F.min_by(F.struct(*columns, ACTION_COL), VERSION_COL).alias("before")
    first = changes.groupBy(*quoted(table.keys)).agg(before).select("before.*")
    return unmatched_rows(rows, first, table.keys).unionByName(
        first.filter(F.col(ACTION_COL) == "update").select(*columns)
    )


# --- Merges -------------------------------------------------------------------------------------


def write_table_merge(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    merge_keys: Sequence[str],
    *,
    stored: bool = False,
    batch_id: str | None = None,
    details: Mapping[str, int] | None = None,
) -> MergeResult:
    """Upsert df into the table at path as its next version.

    Rows match on merge_keys alone: a row whose partition column changed leaves its old partition.
    stored says that df reads from stored files; otherwise it is written to staging first. That it
    holds each key once is checked either way, by counts combined map-side. batch_id and details
    are kept with the merge's counts, see published_batch.
    """
    try:
        table = load_table(spark, path)
        _finish_pending(spark, table)
        source = conform(df, table.schema)
        with StagingArea(spark, "merge") as staging:
            if not stored:
                source = staging.write(source, "source")
            require_unique(source, merge_keys)
            return _merge(spark, table, source, list(merge_keys), staging, batch_id, dict(details or {}))
    except SparkgateError:
        raise
    except Exception as error:
        raise TableMergeError(f"merge into {path} failed: {error}") from error


def _merge(
    spark: SparkSession, table: Table, source: DataFrame, keys: list[str], staging: StagingArea,
    batch_id: str | None, details: dict[str, int],
) -> MergeResult:
    if (table.buckets or table.history) and tuple(keys) != table.keys:
        raise TableMergeError(f"{table.path} is kept by {list(table.keys)}, not by {keys}")
    source_rows = _checked_count(source, table.schema, keys)
    version = get_table_version(spark, table.path) + 1
    target = table.rows(spark)
    before = _rows_before(spark, table, target)
    touched, updated, sieve = None, 0, None
    if source_rows and before:
        # Of a table much larger than the delivery most rows match none of it; buckets stay anyway.
        if SIEVE_ROWS <= source_rows <= before // 2 and not table.buckets and can_sieve(target, source, keys):
            sieve = key_sieve(source, keys, source_rows, staging, "sieve")
        touched = staging.write(matched_partitions(target, source, keys, table.partition_cols, sieve), "touched")
        updated = touched.agg(F.sum(_ROWS)).first()[0] or 0
    result = MergeResult(source_rows - updated, updated, before - updated)
    entry = {"version": version, "batch_id": batch_id, **result.__dict__, "details": details}
    if table.history and source_rows:
        _keep_changes(table, target, source, touched, keys, version)
    if not updated:
        if source_rows:
            # Until the merge is published the ledger's row count cannot be relied on.
            hadoop.remove(spark, f"{table.path}/pending")
            hadoop.write_text(spark, f"{table.path}/pending/appending", json.dumps(entry))
            _insert(spark, table, source, overwrite=False)
        _publish(spark, table, entry)
        hadoop.remove(spark, f"{table.path}/pending")
        return result

    old = target
    if table.partition_cols:
        received = source.select(*quoted(table.partition_cols))
        affected = touched.select(*quoted(table.partition_cols)).union(received).distinct()
        old = _in_partitions(target, staging.write(affected, "affected"), table.partition_cols)
    merged = unmatched_rows(old, source, keys, sieve).unionByName(source.select(*quoted(target.columns)))
    pending = f"{table.path}/pending"
    merged.write.mode("overwrite").parquet(f"{pending}/rows")
    touched.write.mode("overwrite").parquet(f"{pending}/touched")
    hadoop.write_text(spark, f"{pending}/ready", json.dumps(entry))
    _finish_pending(spark, table)
    return result


def _rows_before(spark: SparkSession, table: Table, target: DataFrame) -> int:
    """Row count before the merge, from the ledger; counted from footers where that may be wrong."""
    merges = _merges(spark, table.path)
    if not merges or hadoop.exists(spark, f"{table.path}/pending/appending"):
        return target.count()
    last = json.loads(hadoop.read_text(spark, f"{table.path}/merges/{merges[-1][1]}"))
    return last["rows_inserted"] + last["rows_updated"] + last["rows_unchanged"]


def matched_partitions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partition_cols: Sequence[str],
    sieve: KeySieve | None = None,
) -> DataFrame:
    """Per partition of the target with rows the source matches: their number, and one of its files.

    Reads keys only, and of those only row groups within the ranges of the source's keys; a sieve of
    these has fewer of them shuffled.
    """
    ranges = key_ranges(source, keys[0])
    rows = target.filter(within_ranges(keys[0], ranges)).select(
        *quoted(dict.fromkeys([*keys, *partition_cols])), F.col("_metadata.file_path").alias(_FILE)
    )
    matched = matched_rows(rows, source, keys, sieve)
    return matched.groupBy(*quoted(partition_cols)).agg(F.count(F.lit(1)).alias(_ROWS), F.min(_FILE).alias(_FILE))


def _in_partitions(target: DataFrame, partitions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the target in these partitions, of which there are few: others are not read."""
    if not columns:
        return target
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(f"`{name}`").isNull()
    named = target.join(F.broadcast(partitions.filter(~missing)), list(columns), "left_semi").select(*quoted(target.columns))
    same = F.lit(True)
    for name in columns:
        same = same & F.col(f"t.`{name}`").eqNullSafe(F.col(f"p.`{name}`"))
    unnamed = target.filter(missing).alias("t").join(F.broadcast(partitions.filter(missing).alias("p")), same, "left_semi")
    return named.unionByName(unnamed.select(*[F.col(f"t.`{name}`") for name in target.columns]))


def _insert(spark: SparkSession, table: Table, rows: DataFrame, *, overwrite: bool) -> None:
    """Have Spark write rows into the table; overwriting replaces the partitions they belong to.

    Adaptive execution gives each partition few files, and splits one that is too large for one.
    """
    by = [*table.partition_cols, *table.keys]
    rows = rows.select(*quoted(table.insert_order))
    if table.buckets:
        rows = rows.repartition(table.buckets, *quoted(table.keys))
    elif table.partition_cols:
        rows = rows.hint("rebalance", *table.partition_cols)
    if by:
        # Sorted files have narrow key ranges, which later merges skip by.
        rows = rows.sortWithinPartitions(*quoted(by))
    rows.write.insertInto(table.name, overwrite=overwrite)
    spark.catalog.refreshTable(table.name)


def _overwriting_session(spark: SparkSession) -> SparkSession:
    """A session of its own, for the mode is a setting: other threads must not meet it."""
    session = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return session


def _finish_pending(spark: SparkSession, table: Table) -> None:
    """Write what a merge has stored into the table, if there is such; it can be done again."""
    pending = f"{table.path}/pending"
    if not hadoop.exists(spark, f"{pending}/ready"):
        return
    entry = json.loads(hadoop.read_text(spark, f"{pending}/ready"))
    if not any(version >= entry["version"] for version, _ in _merges(spark, table.path)):
        session = _overwriting_session(spark)
        rows = session.read.schema(raw_schema(table.schema)).parquet(f"{pending}/rows")
        touched = session.read.parquet(f"{pending}/touched")
        _insert(session, table, rows, overwrite=True)
        if table.partition_cols:
            same = F.lit(True)
            for name in table.partition_cols:
                same = same & F.col(f"t.`{name}`").eqNullSafe(F.col(f"p.`{name}`"))
            there = rows.select(*quoted(table.partition_cols)).distinct()
            emptied = touched.alias("t").join(F.broadcast(there.alias("p")), same, "left_anti")
            for row in emptied.select(_FILE).toLocalIterator():
                hadoop.remove(spark, unquote(row[0].rpartition("/")[0]))
        spark.catalog.refreshTable(table.name)
        _publish(spark, table, entry)
    hadoop.remove(spark, pending)


def _keep_changes(
    table: Table, target: DataFrame, source: DataFrame, touched: DataFrame | None, keys: list[str], version: int
) -> None:
    """Store the rows that the merge replaces as they are, and the keys of those it inserts."""
    for key in keys:
        if not source.filter(F.col(f"`{key}`").isNull()).isEmpty():
            raise NullKeyError(f"a table with history takes no null in merge key '{key}'")
    columns = quoted(table.schema.fieldNames())
    old = target.limit(0)
    if touched is not None:
        old = _in_partitions(target, touched.select(*quoted(table.partition_cols)), table.partition_cols)
    replaced = old.join(source.select(*quoted(keys)), keys, "left_semi").select(*columns, F.lit("update").alias(ACTION_COL))
    added = source.select(*quoted(keys)).join(old.select(*quoted(keys)), keys, "left_anti")
    changes = replaced.unionByName(added.withColumn(ACTION_COL, F.lit("insert")), allowMissingColumns=True)
    changes.write.mode("overwrite").parquet(f"{table.path}/changes/{VERSION_COL}={version}")


def _checked_count(source: DataFrame, schema: T.StructType, keys: Sequence[str]) -> int:
    """Row count; raises when a column the target declares non-null holds a null."""
    required = required_columns(schema)
    row = source.agg(
        F.count(F.lit(1)).alias(_ROWS),
        *[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in required],
    ).first()
    for name in required:
        if row[name] and name in keys:
            raise NullKeyError(f"{row[name]} source row(s) with null in merge key '{name}'")
        if row[name]:
            raise SchemaError(f"{row[name]} source row(s) with null in required column '{name}'")
    return row[_ROWS]


def merge_into_catalog_table(df: DataFrame, table: str, merge_keys: Sequence[str]) -> None:
    """The same upsert on a catalog table whose format supports MERGE itself."""
    try:
        source = df.alias("__source__")
        matched = F.lit(True)
        for key in merge_keys:
            matched = matched & F.expr(f"{table}.`{key}` = __source__.`{key}`")
        source.mergeInto(table, matched).whenMatched().updateAll().whenNotMatched().insertAll().merge()
    except Exception as error:
        raise TableMergeError(f"merge into {table} failed: {error}") from error
