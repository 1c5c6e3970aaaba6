"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

import pyspark.sql.functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.errors import ValidationError
from sparkgate.functions.conform import conform, union_frames
from sparkgate.functions.names import (
    archive_key,
    bucket_name,
    is_items_workbook,
    is_orders_workbook,
    is_workbook,
    safe_execution_id_column,
)
from sparkgate.operators.key_bitmap import key_bitmaps, known_rows, orphan_rows
from sparkgate.operators.ladder import label_rows, narrowed_to_count, rejected_rows, surviving_rows
from sparkgate.operators.merge import (
    ACTION_COL,
    merge_actions,
    merge_counts,
    merge_rows,
    touched_partitions,
)
from sparkgate.operators.rules import (
    ERROR_COL,
    BooleanFlagRule,
    NotNullRule,
    PositiveAmountRule,
    ReferentialIntegrityRule,
    TimestampRangeRule,
    UniqueKeyRule,
    ValidationRule,
)
from sparkgate.operators.validation import rule_results, validation_summary
from sparkgate.plans import audits
from sparkgate.plans.full_run import archive_file
from sparkgate.plans.jobs import TableJob, run_table_job
from sparkgate.plans.rule_sets import order_items_rules, orders_rules, products_rules
from sparkgate.queries import mapped
from sparkgate.queries.mapped import MAX_TS, MIN_TS, table
from sparkgate.queries.workbook_copies import as_workbooks
from sparkgate.settings import RunSettings, StorageSettings
from sparkgate.sources import catalog
from sparkgate.sources.catalog import follow_schema, register_table
from sparkgate.sources.excel import parse_workbooks
from sparkgate.sources.landing import list_files, read_csv, read_json_lines, write_json_lines
from sparkgate.sources.quarantine import read_quarantine, write_to_quarantine
from sparkgate.sources.run_metrics import read_metrics
from sparkgate.sources.staging import StagingArea
from sparkgate.sources.tables import (
    create_table_if_not_exists,
    get_table_version,
    load_table,
    matched_partitions,
    merge_history,
    read_table,
    write_table_merge,
)
from sparkgate.streaming import alarms
from sparkgate.streaming.landing import start_table_load, stream_csv

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
RUN_DATE = date(2025, 1, 31)
EXECUTION_ID = "arn:run/2025:01"
GATE_LIMIT = 0.05


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- Audits -------------------------------------------------------------------------------------


@query
def products_sanity(spark, sf_dir):
    return audits.products_sanity(mapped.products(spark, sf_dir))


@query
def products_sanity_spoiled(spark, sf_dir):
    return audits.products_sanity(mapped.spoiled_products(spark, sf_dir))


@query
def orders_sanity(spark, sf_dir):
    return audits.orders_sanity(mapped.orders(spark, sf_dir))


@query
def orders_sanity_spoiled(spark, sf_dir):
    return audits.orders_sanity(mapped.spoiled_orders(spark, sf_dir))


@query
def ri_audit(spark, sf_dir):
    return audits.orphaned_order_items(
        mapped.order_items(spark, sf_dir), mapped.orders(spark, sf_dir)
    )


@query
def ri_audit_spoiled(spark, sf_dir):
    return audits.orphaned_order_items(
        mapped.spoiled_order_items(spark, sf_dir), mapped.orders(spark, sf_dir)
    )


@query
def ri_audit_bitmap(spark, sf_dir):
    """The audit with the orders' ids as bitmaps."""
    return audits.orphaned_order_items(
        mapped.spoiled_order_items(spark, sf_dir), mapped.orders(spark, sf_dir), dense_keys=True
    )


def _in_deliveries(rows: DataFrame, key: str, add: Callable[[DataFrame, str], None]) -> None:
    """Hand rows over in three deliveries, the last of which comes twice."""
    delivery = F.pmod(F.coalesce(key, F.lit(0)), F.lit(3))
    for n in (0, 1, 2, 2):
        add(rows.filter(delivery == n), f"run:{n}")


@query
def products_sanity_incremental(spark, sf_dir):
    """The audit over deliveries, each of which was read once, when it came."""
    state = audits.AuditState(f"{StagingArea(spark, 'query').path}/audit")
    _in_deliveries(mapped.spoiled_products(spark, sf_dir), "product_id", state.add_products)
    return state.products_sanity(spark)


@query
def orders_sanity_incremental(spark, sf_dir):
    state = audits.AuditState(f"{StagingArea(spark, 'query').path}/audit")
    _in_deliveries(mapped.spoiled_orders(spark, sf_dir), "order_id", state.add_orders)
    return state.orders_sanity(spark)


# --- Single rules -------------------------------------------------------------------------------


def _rule_pair(name: str, rule: Callable[..., ValidationRule], rows: Query) -> None:
    def valid(spark, sf_dir):
        return rule(spark, sf_dir).validate(rows(spark, sf_dir))[0]

    def invalid(spark, sf_dir):
        return rule(spark, sf_dir).validate(rows(spark, sf_dir))[1]

    QUERIES[f"rule_{name}_valid"] = valid
    QUERIES[f"rule_{name}_invalid"] = invalid


_rule_pair("not_null", lambda *_: NotNullRule("order_id"), mapped.spoiled_orders)
_rule_pair("unique", lambda *_: UniqueKeyRule(["id"]), mapped.order_items)
_rule_pair(
    "unique_pair",
    lambda *_: UniqueKeyRule(["product_id", "add_to_cart_order"], order_by=["order_timestamp"]),
    mapped.order_items,
)
_rule_pair(
    "fk",
    lambda spark, sf_dir: ReferentialIntegrityRule(
        "order_id", mapped.orders(spark, sf_dir), "order_id"
    ),
    mapped.spoiled_order_items,
)
_rule_pair(
    "fk_bitmap",
    lambda spark, sf_dir: ReferentialIntegrityRule(
        "order_id", mapped.orders(spark, sf_dir), "order_id", dense_keys=True
    ),
    mapped.spoiled_order_items,
)
_rule_pair(
    "ts_range",
    lambda *_: TimestampRangeRule("order_timestamp", MIN_TS, MAX_TS),
    mapped.spoiled_orders,
)
_rule_pair(
    "positive",
    lambda *_: PositiveAmountRule("c_acctbal"),
    lambda spark, sf_dir: table(spark, sf_dir, "customer"),
)
_rule_pair("flag", lambda *_: BooleanFlagRule("reordered"), mapped.spoiled_order_items)


def _label_by_flag(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[ValidationRule]]:
    rules = [UniqueKeyRule(["reordered"])]
    items = mapped.order_items(spark, sf_dir)
    return label_rows(items, rules, look_ahead=True, hot_rows=100), rules


@query
def rule_unique_hot_key_valid(spark, sf_dir):
    """Two keys hold all rows, one of them about a third: the split path of the unique rule."""
    return surviving_rows(_label_by_flag(spark, sf_dir)[0])


@query
def rule_unique_hot_key_invalid(spark, sf_dir):
    return rejected_rows(*_label_by_flag(spark, sf_dir))


def _label_by_flag_unseen(spark, sf_dir):
    rules = [UniqueKeyRule(["reordered"])]
    return label_rows(mapped.order_items(spark, sf_dir), rules), rules


@query
def rule_unique_default_hot_valid(spark, sf_dir):
    """The same two keys, without looking at them first."""
    return surviving_rows(_label_by_flag_unseen(spark, sf_dir)[0])


@query
def rule_unique_default_hot_invalid(spark, sf_dir):
    return rejected_rows(*_label_by_flag_unseen(spark, sf_dir))


@query
def rule_unique_look_ahead_valid(spark, sf_dir):
    """Looking at the keys first: only rows of repeated keys are ranked."""
    items = mapped.order_items(spark, sf_dir)
    return surviving_rows(label_rows(items, [UniqueKeyRule(["id"])], look_ahead=True))


@query
def order_items_look_ahead_rejects(spark, sf_dir):
    """The whole chain of order items, looking at keys first."""
    rules = order_items_rules(mapped.orders(spark, sf_dir), MIN_TS, MAX_TS)
    items = mapped.spoiled_order_items(spark, sf_dir)
    return rejected_rows(label_rows(items, rules, look_ahead=True), rules)


@query
def order_items_bitmap_rejects(spark, sf_dir):
    """The whole chain of order items, looking at keys first, with the orders' ids as bitmaps."""
    rules = order_items_rules(mapped.orders(spark, sf_dir), MIN_TS, MAX_TS, dense_keys=True)
    items = mapped.spoiled_order_items(spark, sf_dir)
    return rejected_rows(label_rows(items, rules, look_ahead=True), rules)


class PriceCeilingRule(ValidationRule):
    """A user's own rule, written as a plain split."""

    rule_name = "price_ceiling:p_retailprice"

    def validate(self, df):
        cheap = F.coalesce(F.col("p_retailprice") <= 1500, F.lit(False))
        return df.filter(cheap), df.filter(~cheap).withColumn(ERROR_COL, F.lit("costs over 1500"))


@query
def custom_rule_rejects(spark, sf_dir):
    """A splitting rule between built-in ones."""
    rules = [NotNullRule("p_partkey"), PriceCeilingRule(), UniqueKeyRule(["p_name", "p_brand"])]
    return rejected_rows(label_rows(table(spark, sf_dir, "part"), rules), rules)


# --- Rule chains --------------------------------------------------------------------------------


def _labelled(rows, rules, counted=False):
    """The rows with their labels, or only what it takes to count labels."""
    return label_rows(narrowed_to_count(rows, rules) if counted else rows, rules), rules


def _products_chain(spark, sf_dir, **options):
    return _labelled(mapped.spoiled_products(spark, sf_dir), products_rules(), **options)


def _orders_chain(spark, sf_dir, **options):
    return _labelled(mapped.spoiled_orders(spark, sf_dir), orders_rules(MIN_TS, MAX_TS), **options)


def _order_items_chain(spark, sf_dir, **options):
    rules = order_items_rules(mapped.orders(spark, sf_dir), MIN_TS, MAX_TS)
    return _labelled(mapped.spoiled_order_items(spark, sf_dir), rules, **options)


_CHAINS = {
    "products": _products_chain,
    "orders": _orders_chain,
    "order_items": _order_items_chain,
}


def _register_chain(name: str, chain: Callable) -> None:
    def rejects(spark, sf_dir):
        return rejected_rows(*chain(spark, sf_dir))

    def valid(spark, sf_dir):
        return surviving_rows(chain(spark, sf_dir)[0])

    def results(spark, sf_dir):
        return rule_results(*chain(spark, sf_dir, counted=True))

    def summary(spark, sf_dir):
        return validation_summary(chain(spark, sf_dir, counted=True)[0])

    QUERIES[f"{name}_validate_rejects"] = rejects
    QUERIES[f"{name}_validate_valid"] = valid
    QUERIES[f"{name}_rule_results"] = results
    QUERIES[f"{name}_validation_summary"] = summary


for _name, _chain in _CHAINS.items():
    _register_chain(_name, _chain)


@query
def threshold_gate_report(spark, sf_dir):
    """Per table, whether its reject ratio is above the limit."""
    return union_frames(
        validation_summary(chain(spark, sf_dir, counted=True)[0]).select(
            F.lit(name).alias("table_name"),
            "failure_ratio",
            (F.col("failure_ratio") > GATE_LIMIT).alias("over_limit"),
        )
        for name, chain in _CHAINS.items()
    )


# --- Joins and merges ---------------------------------------------------------------------------


@query
def join_anti_orphans(spark, sf_dir):
    items = mapped.spoiled_order_items(spark, sf_dir)
    return items.join(mapped.orders(spark, sf_dir).select("order_id"), "order_id", "left_anti")


@query
def join_semi_known(spark, sf_dir):
    items = mapped.spoiled_order_items(spark, sf_dir)
    return items.join(mapped.orders(spark, sf_dir).select("order_id"), "order_id", "left_semi")


@query
def join_anti_orphans_bitmap(spark, sf_dir):
    bitmaps = key_bitmaps(mapped.orders(spark, sf_dir), "order_id")
    return orphan_rows(mapped.spoiled_order_items(spark, sf_dir), "order_id", bitmaps)


@query
def join_semi_known_bitmap(spark, sf_dir):
    bitmaps = key_bitmaps(mapped.orders(spark, sf_dir), "order_id")
    return known_rows(mapped.spoiled_order_items(spark, sf_dir), "order_id", bitmaps)


def _merge_sides(spark, sf_dir):
    return mapped.known_orders(spark, sf_dir), mapped.delivered_orders(spark, sf_dir), ["order_id"]


@query
def merge_upsert_result(spark, sf_dir):
    return merge_actions(*_merge_sides(spark, sf_dir)).withColumnRenamed(ACTION_COL, "action")


@query
def merge_upsert_rows(spark, sf_dir):
    return merge_rows(*_merge_sides(spark, sf_dir))


@query
def merge_upsert_counts(spark, sf_dir):
    return merge_counts(*_merge_sides(spark, sf_dir))


@query
def merge_touched_partitions(spark, sf_dir):
    return touched_partitions(*_merge_sides(spark, sf_dir), ["date"])


class SmallSizeRule(ValidationRule):
    """Another split of a user's own."""

    rule_name = "small_size:p_size"

    def validate(self, df):
        small = F.coalesce(F.col("p_size") <= 40, F.lit(False))
        return df.filter(small), df.filter(~small).withColumn(ERROR_COL, F.lit("larger than 40"))


@query
def custom_rules_chain(spark, sf_dir):
    """Two splitting rules after a unique rule."""
    rules = [UniqueKeyRule(["p_name", "p_brand"]), PriceCeilingRule(), SmallSizeRule()]
    return rejected_rows(label_rows(table(spark, sf_dir, "part"), rules), rules)


# --- Versioned tables ---------------------------------------------------------------------------


def _merge_customers_twice(spark, sf_dir, partition_cols=("c_mktsegment",), **layout) -> tuple[str, list[tuple]]:
    """Load all customers by segment, then move those in debt to a segment of their own."""
    customers = table(spark, sf_dir, "customer")
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, f.name != "c_custkey") for f in customers.schema.fields]
    )
    path = f"{StagingArea(spark, 'query').path}/customers"
    create_table_if_not_exists(spark, schema, path, partition_cols, keys=["c_custkey"], **layout)
    moved = customers.filter(F.col("c_acctbal") <= 0).withColumn("c_mktsegment", F.lit("REVIEW"))
    steps = []
    for source in (customers, moved):
        result = write_table_merge(spark, source, path, ["c_custkey"])
        version = get_table_version(spark, path)
        steps.append(
            (version, result.rows_inserted, result.rows_updated, result.rows_unchanged)
        )
    return path, steps


@query
def table_merge_read(spark, sf_dir):
    """The table after both merges: moved rows have left their old partitions."""
    path, _ = _merge_customers_twice(spark, sf_dir)
    return read_table(spark, path)


@query
def table_merge_first_version(spark, sf_dir):
    """The same table as it was before the second merge."""
    path, _ = _merge_customers_twice(spark, sf_dir, history=True)
    return read_table(spark, path, version=1)


@query
def table_merge_counts(spark, sf_dir):
    """Version and row counts after each merge."""
    _, steps = _merge_customers_twice(spark, sf_dir)
    return spark.createDataFrame(
        steps, "version bigint, rows_inserted bigint, rows_updated bigint, rows_unchanged bigint"
    )


@query
def table_bucketed_read(spark, sf_dir):
    """The same table kept in buckets by key, without partitions."""
    path, _ = _merge_customers_twice(spark, sf_dir, partition_cols=(), buckets=8)
    return read_table(spark, path)


@query
def table_merge_ledger(spark, sf_dir):
    """The counts of both merges, as the table's ledger keeps them."""
    path, _ = _merge_customers_twice(spark, sf_dir, partition_cols=(), buckets=8)
    return merge_history(spark, path).drop("details")


@query
def table_touched_pruned(spark, sf_dir):
    """Days of the orders table that a small delivery touches, found by its ranges of keys."""
    path = f"{StagingArea(spark, 'query').path}/orders"
    orders = mapped.known_orders(spark, sf_dir)
    create_table_if_not_exists(spark, orders.schema, path, ["date"])
    write_table_merge(spark, orders, path, ["order_id"])
    delivery = mapped.orders(spark, sf_dir).filter(F.col("order_id") % 50 == 0)
    target = load_table(spark, path).rows(spark)
    touched = matched_partitions(target, delivery, ["order_id"], ["date"])
    return touched.select("date", F.col("__rows__").alias("orders"))


def _widened_customers(spark, sf_dir) -> str:
    """The customers table, into whose folder another program has put suppliers with a column more."""
    path, _ = _merge_customers_twice(spark, sf_dir)
    suppliers = table(spark, sf_dir, "supplier").select(
        (-F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"), F.lit("supplier").alias("party"),
    )
    suppliers.write.parquet(f"{path}/data/c_mktsegment=SUPPLY")
    spark.catalog.recoverPartitions(load_table(spark, path).name)
    return path


@query
def schema_drift(spark, sf_dir):
    """What the catalog does not know of the files in a table's folder."""
    return catalog.schema_drift(spark, _widened_customers(spark, sf_dir))


@query
def schema_followed_rows(spark, sf_dir):
    """The rows of that table once the catalog has followed its files."""
    path = _widened_customers(spark, sf_dir)
    follow_schema(spark, path)
    return read_table(spark, path)


@query
def table_registered_sql(spark, sf_dir):
    """SQL by name over a registered table."""
    path, _ = _merge_customers_twice(spark, sf_dir)
    register_table(spark, "sparkgate_queries.customers", path)
    return spark.sql(
        "SELECT c_mktsegment, count(*) AS customers, min(c_acctbal) AS lowest "
        "FROM sparkgate_queries.customers GROUP BY c_mktsegment"
    )


# --- Whole jobs ---------------------------------------------------------------------------------


def _settings(base: str, limit: float = 1.0) -> RunSettings:
    storage = StorageSettings(f"{base}/raw", f"{base}/processed", f"{base}/rejects", f"{base}/old")
    return RunSettings(
        "query-job", "test", storage, execution_id=EXECUTION_ID, max_quarantine_ratio=limit
    )


def _job(name: str, schema: T.StructType, keys, partition_cols, rules) -> TableJob:
    return TableJob(name, schema, keys, partition_cols, rules)


def _run_products(spark, sf_dir, base, rows=None, limit=1.0, **options):
    rows = mapped.spoiled_products(spark, sf_dir) if rows is None else rows
    job = _job("products", rows.schema, ["product_id"], [], products_rules())
    return run_table_job(spark, job, _settings(base, limit), lambda: rows, **options)


def _refused_run(spark, sf_dir, base):
    """A products run over other names, which its gate must refuse."""
    rows = mapped.spoiled_products(spark, sf_dir)
    changed = rows.withColumn("product_name", F.upper("product_name"))
    try:
        _run_products(spark, sf_dir, base, changed, limit=0.0)
    except ValidationError:
        return
    raise AssertionError("the gate let the run pass")


def _run_orders(spark, sf_dir, base, rows=None):
    rows = mapped.spoiled_orders(spark, sf_dir) if rows is None else rows
    job = _job("orders", rows.schema, ["order_id"], ["date"], orders_rules(MIN_TS, MAX_TS))
    return run_table_job(spark, job, _settings(base), lambda: rows)


def _run_items(spark, sf_dir, base, rows=None):
    rows = mapped.spoiled_order_items(spark, sf_dir) if rows is None else rows
    orders = read_table(spark, _settings(base).storage.table_path("orders"))
    rules = order_items_rules(orders, MIN_TS, MAX_TS)
    job = _job("order_items", rows.schema, ["id"], ["date"], rules)
    return run_table_job(spark, job, _settings(base), lambda: rows)


def _moved_a_day(rows: DataFrame) -> DataFrame:
    """The rows of every tenth order, a day later than before."""
    return rows.filter(F.col("order_id") % 10 == 0).withColumn("date", F.date_add("date", 1))


@query
def jobs_summary(spark, sf_dir):
    """Counts of the products job, run twice over the same input."""
    base = StagingArea(spark, "query").path
    runs = [(n, *_run_products(spark, sf_dir, base).values()) for n in (1, 2)]
    return spark.createDataFrame(
        runs,
        "run int, total bigint, valid bigint, rejected bigint, inserted bigint, updated bigint",
    )


@query
def gate_keeps_table(spark, sf_dir):
    """The products table after a run that passed its gate and one that did not."""
    base = StagingArea(spark, "query").path
    _run_products(spark, sf_dir, base)
    _refused_run(spark, sf_dir, base)
    return read_table(spark, _settings(base).storage.table_path("products"))


@query
def gate_keeps_rejects(spark, sf_dir):
    """What a refused run leaves in quarantine."""
    base = StagingArea(spark, "query").path
    _refused_run(spark, sf_dir, base)
    kept = read_quarantine(spark, _settings(base).storage.quarantine_base_path, "products")
    return kept.drop("table", "run_date", "execution_id")


@query
def jobs_metrics(spark, sf_dir):
    """The metrics row a job leaves, without its duration."""
    base = StagingArea(spark, "query").path
    _run_products(spark, sf_dir, base)
    return read_metrics(spark, _settings(base).storage.metrics_path).drop("duration_ms")


@query
def replay_metrics(spark, sf_dir):
    """The metrics rows of one batch that came three times."""
    base = StagingArea(spark, "query").path
    for _ in range(3):
        _run_products(spark, sf_dir, base, batch_id="delivery-1", replace_quarantine=True)
    return read_metrics(spark, _settings(base).storage.metrics_path).drop("duration_ms")


@query
def jobs_all_summaries(spark, sf_dir):
    """Counts of the three jobs, and of a run without input."""
    base = StagingArea(spark, "query").path
    nothing = mapped.spoiled_products(spark, sf_dir).filter("product_id < 0")
    runs = {
        "no products": _run_products(spark, sf_dir, base, nothing),
        "products": _run_products(spark, sf_dir, base),
        "orders": _run_orders(spark, sf_dir, base),
        "order_items": _run_items(spark, sf_dir, base),
    }
    return spark.createDataFrame(
        [(name, *counts.values()) for name, counts in runs.items()],
        "job string, total bigint, valid bigint, rejected bigint, inserted bigint, updated bigint",
    )


@query
def jobs_orders_table(spark, sf_dir):
    """The orders table, partitioned by date, after its job."""
    base = StagingArea(spark, "query").path
    _run_orders(spark, sf_dir, base)
    return read_table(spark, _settings(base).storage.table_path("orders"))


@query
def jobs_order_items_table(spark, sf_dir):
    """The order items table after both jobs: items are checked against the loaded orders."""
    base = StagingArea(spark, "query").path
    _run_orders(spark, sf_dir, base)
    _run_items(spark, sf_dir, base)
    return read_table(spark, _settings(base).storage.table_path("order_items"))


@query
def jobs_orders_rerun(spark, sf_dir):
    """The orders table after a second run that moves every tenth order to the next day."""
    base = StagingArea(spark, "query").path
    _run_orders(spark, sf_dir, base)
    _run_orders(spark, sf_dir, base, _moved_a_day(mapped.spoiled_orders(spark, sf_dir)))
    return read_table(spark, _settings(base).storage.table_path("orders"))


@query
def jobs_order_items_rerun(spark, sf_dir):
    """The order items table after a second run that moves the items of every tenth order to the next day."""
    base = StagingArea(spark, "query").path
    _run_orders(spark, sf_dir, base)
    _run_items(spark, sf_dir, base)
    _run_items(spark, sf_dir, base, _moved_a_day(mapped.spoiled_order_items(spark, sf_dir)))
    return read_table(spark, _settings(base).storage.table_path("order_items"))


@query
def quarantine_rows(spark, sf_dir):
    """Rejected orders as read back from quarantine."""
    base = StagingArea(spark, "query").path
    rejects = rejected_rows(*_orders_chain(spark, sf_dir))
    write_to_quarantine(rejects, base, "orders", EXECUTION_ID, RUN_DATE.isoformat())
    return read_quarantine(spark, base, "orders").withColumnRenamed("table", "table_name")


# --- Landing files ------------------------------------------------------------------------------


@query
def csv_scan(spark, sf_dir):
    """Products through CSV; keys that are no numbers read as null."""
    base = StagingArea(spark, "query").path
    rows = mapped.products(spark, sf_dir)
    text = F.when(F.col("product_id") % 97 == 0, F.concat(F.lit("x"), F.col("product_id")))
    rows.withColumn(
        "product_id", F.coalesce(text, F.col("product_id").cast("string"))
    ).write.option("header", "true").csv(base)
    return read_csv(spark, base, rows.schema)


def _landed_products(spark, sf_dir) -> str:
    """A landing folder with a subfolder of products per department."""
    base = f"{StagingArea(spark, 'query').path}/landing"
    rows = mapped.products(spark, sf_dir).withColumn("folder", F.col("department_id"))
    rows.repartition("folder").write.partitionBy("folder").option("header", "true").csv(base)
    return base


@query
def listed_files(spark, sf_dir):
    """Files of a landing folder and its subfolders, counted by subfolder."""
    found = list_files(spark, _landed_products(spark, sf_dir), F.col("file_name").endswith(".csv"))
    folder = F.regexp_extract("path", "folder=([^/]+)", 1).cast("int")
    return found.groupBy(folder.alias("department_id")).agg(F.count_if(F.col("length") > 0).alias("files"))


@query
def archived_files(spark, sf_dir):
    """Products read from the archive, after all files of the landing folder were moved there."""
    base = f"{StagingArea(spark, 'query').path}/landing"
    rows = mapped.products(spark, sf_dir)
    rows.repartition(5).write.option("header", "true").csv(base)
    for row in list_files(spark, base, F.col("file_name").endswith(".csv")).select("path").toLocalIterator():
        archive_file(spark, row.path, f"{base}-archive")
    if not list_files(spark, base).isEmpty():
        raise AssertionError("files are left in the landing folder")
    reader = spark.read.option("recursiveFileLookup", "true").option("header", "true")
    return reader.schema(rows.schema).csv(f"{base}-archive")


@query
def json_lines_scan(spark, sf_dir):
    """Order items, some fields null, through JSON lines."""
    base = StagingArea(spark, "query").path
    rows = mapped.spoiled_order_items(spark, sf_dir)
    write_json_lines(rows, base)
    return read_json_lines(spark, base, rows.schema)


@query
def excel_scan(spark, sf_dir):
    """Orders, some cells empty, through Excel workbooks spread over the tasks."""
    rows = mapped.spoiled_orders(spark, sf_dir).repartition("order_num")
    return parse_workbooks(as_workbooks(rows), rows.schema)


# --- Projections and name functions -------------------------------------------------------------


@query
def conform_schema(spark, sf_dir):
    """Orders as loose text, with bad values, one column missing and one too many."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        F.col("o_totalprice").cast("string").alias("total_amount"),
        F.when(F.col("o_orderkey") % 97 == 0, "n/a")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("user_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )
    schema = T.StructType.fromDDL(
        "order_num bigint, order_id bigint, user_id int, total_amount double, date date"
    )
    return conform(rows, schema)


@query
def conform_nan(spark, sf_dir):
    """A NaN becomes a missing integer."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "N", F.lit(float("nan")))
        .otherwise(F.col("l_quantity"))
        .alias("l_quantity"),
    )
    schema = T.StructType.fromDDL("l_orderkey bigint, l_linenumber int, l_quantity int")
    return conform(rows, schema)


@query
def union_by_name_missing(spark, sf_dir):
    """Customers and suppliers in one frame; suppliers have no segment."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("party_id")
    )
    return union_frames([customers, suppliers])


@query
def defect_injection(spark, sf_dir):
    return mapped.spoiled_orders(spark, sf_dir)


@query
def archive_keys(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", archive_key(F.col("url"), F.lit(RUN_DATE)).alias("archive_key")
    )


@query
def archive_keys_encoded(spark, sf_dir):
    """Keys that hold spaces and letters outside ASCII, encoded as object stores report them."""
    name = F.concat(F.lit("page "), F.col("page_id").cast("string"), F.lit(" é.html"))
    key = F.concat(F.lit("incoming/"), F.url_encode(name))
    return table(spark, sf_dir, "pages").select(
        "page_id", key.alias("key"), archive_key(key, F.lit(RUN_DATE)).alias("archive_key")
    )


@query
def file_routing(spark, sf_dir):
    """Which reader takes a file of a given name."""
    name = F.concat(
        F.when(F.col("p_size") % 2 == 0, "Order_Items_").otherwise("orders_"),
        F.col("p_partkey"),
        F.when(F.col("p_size") % 3 == 0, ".XLSX").when(F.col("p_size") % 3 == 1, ".xlsx")
        .otherwise(".csv"),
    )
    return table(spark, sf_dir, "part").select(
        name.alias("file_name"),
        is_workbook(name).alias("is_workbook"),
        is_orders_workbook(name).alias("for_orders"),
        is_items_workbook(name).alias("for_items"),
    )


@query
def bucket_names(spark, sf_dir):
    location = F.concat(F.lit("s3://"), F.lower("p_brand"), F.lit("-"), "p_partkey", F.lit("//"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", bucket_name(location).alias("bucket")
    )


@query
def execution_ids(spark, sf_dir):
    run = F.concat(F.lit("arn:run:"), "event_type", F.lit("/"), "event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", safe_execution_id_column(run).alias("execution_id")
    )


# --- Alarms and streams -------------------------------------------------------------------------


def _register_alarm(name: str, metric: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark, sf_dir):
        return metric(mapped.run_events(table(spark, sf_dir, "events")))

    QUERIES[name] = run


_register_alarm("errors_5m", alarms.error_counts)
_register_alarm("alarm_errors_5m", alarms.error_alarms)
_register_alarm("rejects_5m", alarms.reject_sums)
_register_alarm("alarm_value_spike_5m", alarms.reject_alarms)
_register_alarm("completions_5m", alarms.completions)

LATE = "10 minutes"


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session whose number of state partitions fits the cores at hand."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return session


def _in_order_of_time(events: DataFrame, folder: str, parts: int) -> None:
    """Write events as files that come one after the other, as a stream takes them."""
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(second), F.max(second)).first()
    place = F.floor((second - F.lit(low)) * parts / (F.lit(high) - F.lit(low) + 1))
    for n in range(parts):
        events.filter(place == n).coalesce(1).write.mode("append").parquet(folder)


def _streamed(spark, sf_dir, metric, files_per_batch=None, base=None, **options) -> DataFrame:
    """All windows, as a stream keeps them that has read all events."""
    session = _stream_session(spark)
    base = base or StagingArea(spark, "query").path
    schema = table(session, sf_dir, "events").schema
    reader = session.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    folder = sf_dir
    if files_per_batch:
        folder = f"{base}/events"
        _in_order_of_time(table(session, sf_dir, "events"), folder, 6)
        reader = session.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    events = reader.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))
    windows = metric(mapped.run_events(events), late=LATE)
    alarms.start_alarm_table(windows, f"{base}/windows", f"{base}/checkpoint", **options).awaitTermination()
    return (
        alarms.read_alarm_table(spark, f"{base}/windows", windows.schema)
        .withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    )


def _register_stream(name: str, metric: Callable[..., DataFrame], **options) -> None:
    QUERIES[name] = lambda spark, sf_dir: _streamed(spark, sf_dir, metric, **options)


_register_stream("stream_errors_5m", alarms.error_counts)
_register_stream("stream_value_spike_5m", alarms.reject_alarms)
_register_stream("stream_completions_5m", alarms.completions)
# The same windows from a table whose batches are put together as they go.
_register_stream("stream_errors_compacted_5m", alarms.error_counts, files_per_batch=1, compact_every=2, open_for="2 hours")


@query
def alarm_transitions(spark, sf_dir):
    """When the error alarm of each job turned on and off."""
    events = mapped.run_events(table(spark, sf_dir, "events"))
    return alarms.error_transitions(alarms.error_counts(events, quiet=True))


@query
def alarm_reject_transitions(spark, sf_dir):
    """When the alarm on rejected records of each job turned on and off."""
    events = mapped.run_events(table(spark, sf_dir, "events"))
    return alarms.reject_transitions(alarms.reject_sums(events, quiet=True))


@query
def stream_alarm_transitions(spark, sf_dir):
    """The error alarm's changes, from the windows that a stream keeps."""
    quiet = partial(alarms.error_counts, quiet=True)
    return alarms.error_transitions(_streamed(spark, sf_dir, quiet, files_per_batch=2))


def _load_stream(spark, sf_dir, base, limit=1.0):
    rows = mapped.spoiled_products(spark, sf_dir)
    settings = _settings(base, limit)
    job = _job("products", rows.schema, ["product_id"], [], products_rules())
    start_table_load(
        spark,
        stream_csv(spark, f"{base}/landing", rows.schema),
        job,
        settings,
        f"{base}/checkpoint",
    ).awaitTermination()
    return settings.storage


@query
def stream_products_load(spark, sf_dir):
    """Products arriving as CSV files, loaded by a stream of gated batches."""
    base = StagingArea(spark, "query").path
    mapped.spoiled_products(spark, sf_dir).write.option("header", "true").csv(f"{base}/landing")
    return read_table(spark, _load_stream(spark, sf_dir, base).table_path("products"))


@query
def stream_retried_rejects(spark, sf_dir):
    """What quarantine holds once a batch that its gate refused has come again under a higher limit."""
    base = StagingArea(spark, "query").path
    mapped.spoiled_products(spark, sf_dir).write.option("header", "true").csv(f"{base}/landing")
    try:
        _load_stream(spark, sf_dir, base, limit=0.0)
    except StreamingQueryException:
        storage = _load_stream(spark, sf_dir, base)
        rejects = read_quarantine(spark, storage.quarantine_base_path, "products")
        return rejects.drop("table", "run_date", "execution_id")
    raise AssertionError("the gate let the batch pass")
