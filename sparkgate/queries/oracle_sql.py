"""For each registered query, the same result in ANSI SQL over the given tables."""

from __future__ import annotations

MIN_TS = "TIMESTAMP '1995-06-01 00:00:00'"
MAX_TS = "TIMESTAMP '2001-06-01 00:00:00'"

# --- The mapped views of queries.mapped -----------------------------------------------------------

PRODUCTS = """
    SELECT p_partkey AS product_id, p_size AS department_id, p_type AS department,
           p_name AS product_name
    FROM part"""

ORDERS = """
    SELECT o_orderkey AS order_num, o_orderkey AS order_id, o_custkey AS user_id,
           o_orderdate AS order_timestamp, o_totalprice AS total_amount,
           CAST(o_orderdate AS DATE) AS date
    FROM orders"""

ORDER_ITEMS = """
    SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_suppkey AS user_id,
           CASE WHEN l_linenumber > 1 THEN CAST(l_quantity AS INTEGER) END
               AS days_since_prior_order,
           l_partkey AS product_id, l_linenumber AS add_to_cart_order,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS reordered,
           l_shipdate AS order_timestamp, CAST(l_shipdate AS DATE) AS date
    FROM lineitem"""

SPOILED_PRODUCTS = f"""
    SELECT CASE WHEN product_id % 97 = 0 THEN NULL ELSE product_id END AS product_id,
           department_id,
           CASE WHEN product_id % 89 = 0 THEN NULL ELSE department END AS department,
           CASE WHEN product_id % 83 = 0 THEN NULL ELSE product_name END AS product_name
    FROM (SELECT * FROM ({PRODUCTS}) UNION ALL
          SELECT * FROM ({PRODUCTS}) WHERE product_id % 71 = 0)"""

SPOILED_ORDERS = f"""
    SELECT order_num,
           CASE WHEN order_num % 97 = 0 THEN NULL ELSE order_id END AS order_id,
           CASE WHEN order_num % 73 = 0 THEN NULL ELSE user_id END AS user_id,
           CASE WHEN order_num % 101 = 0 THEN NULL
                WHEN order_num % 79 = 0 THEN TIMESTAMP '1990-01-01 00:00:00'
                ELSE order_timestamp END AS order_timestamp,
           CASE WHEN order_num % 89 = 0 THEN -total_amount
                WHEN order_num % 83 = 0 THEN CAST(0 AS DOUBLE)
                ELSE total_amount END AS total_amount,
           date
    FROM (SELECT * FROM ({ORDERS}) UNION ALL
          SELECT * FROM ({ORDERS}) WHERE order_num % 71 = 0)"""

SPOILED_ORDER_ITEMS = f"""
    SELECT CASE WHEN order_id % 97 = 0 THEN NULL ELSE id END AS id,
           CASE WHEN order_id % 103 = 0 THEN NULL
                WHEN order_id % 89 = 0 THEN order_id + 1000000000000
                ELSE order_id END AS order_id,
           user_id, days_since_prior_order,
           CASE WHEN order_id % 101 = 0 THEN NULL ELSE product_id END AS product_id,
           add_to_cart_order,
           CASE WHEN order_id % 83 = 0 THEN 2 ELSE reordered END AS reordered,
           CASE WHEN order_id % 79 = 0 THEN TIMESTAMP '1990-01-01 00:00:00'
                ELSE order_timestamp END AS order_timestamp,
           date
    FROM ({ORDER_ITEMS})"""

RUN_EVENTS = """
    SELECT ts,
           CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
           CASE WHEN event_type = 'purchase' THEN 'JOB_COMPLETE'
                ELSE upper(event_type) END AS event,
           CASE WHEN user_id % 3 = 0 THEN 'products-etl'
                WHEN user_id % 3 = 1 THEN 'orders-etl'
                ELSE 'order-items-etl' END AS job_name,
           CASE WHEN user_id % 5 = 0 THEN 'test' ELSE 'dev' END AS environment,
           CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END
               AS records_rejected
    FROM events"""

PRODUCT_COLUMNS = ["product_id", "department_id", "department", "product_name"]
ORDER_COLUMNS = ["order_num", "order_id", "user_id", "order_timestamp", "total_amount", "date"]
ITEM_COLUMNS = [
    "id",
    "order_id",
    "user_id",
    "days_since_prior_order",
    "product_id",
    "add_to_cart_order",
    "reordered",
    "order_timestamp",
    "date",
]

# --- Rules as plain SQL ---------------------------------------------------------------------------


def _order(columns, leading=()):
    names = [*leading, *[c for c in columns if c not in leading]]
    return ", ".join(f"{c} ASC NULLS FIRST" for c in names)


def _ranked(rows, keys, columns, leading=()):
    rest = [c for c in columns if c not in keys]
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {_order(rest, leading)}) AS rn FROM ({rows})"
    )


def _quote(text):
    return "'" + text.replace("'", "''") + "'"


def _pair(name, rows, fails, reason, oracles):
    oracles[f"rule_{name}_valid"] = f"SELECT * FROM ({rows}) t WHERE NOT ({fails})"
    oracles[f"rule_{name}_invalid"] = (
        f"SELECT *, {_quote(reason)} AS __error_reason__ FROM ({rows}) t WHERE {fails}"
    )


def _unique_pair(name, rows, keys, columns, oracles, leading=()):
    ranked = _ranked(rows, keys, columns, leading)
    shown = ", ".join(columns)
    oracles[f"rule_{name}_valid"] = f"SELECT {shown} FROM ({ranked}) WHERE rn = 1"
    oracles[f"rule_{name}_invalid"] = (
        f"SELECT {shown}, {_quote(f'duplicate key on columns: {keys}')} AS __error_reason__ "
        f"FROM ({ranked}) WHERE rn > 1"
    )


NULL_REASON = "null value in required column '{}'"
FK_FAILS = f"NOT EXISTS (SELECT 1 FROM ({ORDERS}) o WHERE o.order_id = t.order_id)"
FK_REASON = (
    "referential_integrity_violation: 'order_id' not found in reference table column 'order_id'"
)
TS_FAILS = f"NOT COALESCE(order_timestamp BETWEEN {MIN_TS} AND {MAX_TS}, FALSE)"
TS_REASON = "'order_timestamp' out of range [1995-06-01T00:00:00, 2001-06-01T00:00:00]"
AMOUNT_FAILS = "NOT COALESCE(total_amount > 0, FALSE)"
FLAG_FAILS = "NOT COALESCE(reordered IN (0, 1), FALSE)"

# A step is (rule name, reason, fails), where fails is a predicate or the keys of a unique rule.
PRODUCT_STEPS = [
    ("not_null:product_id", NULL_REASON.format("product_id"), "product_id IS NULL"),
    ("unique_key:product_id", "duplicate key on columns: ['product_id']", ["product_id"]),
    ("not_null:department", NULL_REASON.format("department"), "department IS NULL"),
    ("not_null:product_name", NULL_REASON.format("product_name"), "product_name IS NULL"),
]
ORDER_STEPS = [
    ("not_null:order_id", NULL_REASON.format("order_id"), "order_id IS NULL"),
    ("unique_key:order_id", "duplicate key on columns: ['order_id']", ["order_id"]),
    ("not_null:user_id", NULL_REASON.format("user_id"), "user_id IS NULL"),
    ("not_null:order_timestamp", NULL_REASON.format("order_timestamp"), "order_timestamp IS NULL"),
    ("positive_amount:total_amount", "'total_amount' must be > 0", AMOUNT_FAILS),
    ("timestamp_range:order_timestamp", TS_REASON, TS_FAILS),
]
ITEM_STEPS = [
    ("not_null:id", NULL_REASON.format("id"), "id IS NULL"),
    ("not_null:order_id", NULL_REASON.format("order_id"), "order_id IS NULL"),
    ("not_null:product_id", NULL_REASON.format("product_id"), "product_id IS NULL"),
    ("unique_key:id", "duplicate key on columns: ['id']", ["id"]),
    ("boolean_flag:reordered", "'reordered' must be 0 or 1", FLAG_FAILS),
    ("referential_integrity:order_id", FK_REASON, FK_FAILS),
    ("timestamp_range:order_timestamp", TS_REASON, TS_FAILS),
]


def _chain(rows, steps, columns):
    """WITH clause applying the steps one after another: alive0.. are the survivors, bad1.. the
    rows each step removes."""
    shown = ", ".join(columns)
    parts = [f"alive0 AS ({rows})"]
    for n, (_, _, fails) in enumerate(steps, 1):
        if isinstance(fails, list):
            ranked = _ranked(f"SELECT * FROM alive{n - 1}", fails, columns)
            parts.append(f"ranked{n} AS ({ranked})")
            parts.append(f"bad{n} AS (SELECT {shown} FROM ranked{n} WHERE rn > 1)")
            parts.append(f"alive{n} AS (SELECT {shown} FROM ranked{n} WHERE rn = 1)")
        else:
            parts.append(f"bad{n} AS (SELECT {shown} FROM alive{n - 1} t WHERE {fails})")
            parts.append(f"alive{n} AS (SELECT {shown} FROM alive{n - 1} t WHERE NOT ({fails}))")
    return "WITH " + ",\n".join(parts) + "\n"


def _rejects(steps):
    return "\nUNION ALL\n".join(
        f"SELECT *, {_quote(reason)} AS __error_reason__ FROM bad{n}"
        for n, (_, reason, _) in enumerate(steps, 1)
    )


def _summary(steps):
    failed = " + ".join(f"(SELECT count(*) FROM bad{n})" for n in range(1, len(steps) + 1))
    return (
        f"SELECT total_records, total_records - records_failed AS records_passed, records_failed, "
        f"CASE WHEN total_records > 0 THEN CAST(records_failed AS DOUBLE) / total_records "
        f"ELSE CAST(0 AS DOUBLE) END AS failure_ratio "
        f"FROM (SELECT (SELECT count(*) FROM alive0) AS total_records, "
        f"CAST({failed} AS BIGINT) AS records_failed)"
    )


def _results(steps):
    def row(n, name):
        return (
            f"SELECT {_quote(name)} AS rule_name, records_failed = 0 AS passed, records_failed, "
            f"{_quote(name.split(':')[-1])} AS error_column, "
            f"records_failed || ' record(s) failed rule ''{name}''' AS error_message "
            f"FROM (SELECT count(*) AS records_failed FROM bad{n})"
        )

    return "\nUNION ALL\n".join(row(n, name) for n, (name, _, _) in enumerate(steps, 1))


CHAINS = {
    "products": (SPOILED_PRODUCTS, PRODUCT_STEPS, PRODUCT_COLUMNS),
    "orders": (SPOILED_ORDERS, ORDER_STEPS, ORDER_COLUMNS),
    "order_items": (SPOILED_ORDER_ITEMS, ITEM_STEPS, ITEM_COLUMNS),
}

# --- Merge example --------------------------------------------------------------------------------

MERGE_SIDES = f"""
    WITH target AS (SELECT * FROM ({ORDERS}) WHERE date < DATE '1999-01-01'),
    source AS (SELECT order_num, order_id, user_id, order_timestamp,
                      total_amount + 1.0 AS total_amount,
                      CAST(date + INTERVAL 1 DAY AS DATE) AS date
               FROM ({ORDERS}) WHERE date >= DATE '1997-01-01')"""

_MERGED = ", ".join(
    f"CASE WHEN s.order_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in ORDER_COLUMNS
)
_ACTION = (
    "CASE WHEN s.order_id IS NULL THEN 'unchanged' WHEN t.order_id IS NULL THEN 'insert' "
    "ELSE 'update' END"
)
_FULL = "target t FULL JOIN source s ON t.order_id = s.order_id"

CUSTOMERS_MOVED = """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal,
           CASE WHEN c_acctbal <= 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment
    FROM customer"""

_JOB_COUNTS = """
    SELECT CAST(total AS BIGINT) AS total, CAST(valid AS BIGINT) AS valid,
           CAST(total - valid AS BIGINT) AS rejected
    FROM (SELECT (SELECT count(*) FROM alive0) AS total, (SELECT count(*) FROM alive4) AS valid)"""


def _windows(wanted, value, name, having=""):
    return (
        f"SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, "
        f"time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, "
        f"job_name, environment, {value} AS {name} FROM ({RUN_EVENTS}) "
        f"WHERE {wanted} GROUP BY ALL {having}"
    )


def _transitions(breaching):
    """Breaching periods in a row are one alarm: on at the end of its first, off a period after its last."""
    return f"""
        WITH marked AS (
            SELECT *, lag(window_end) OVER own AS before, lead(window_start) OVER own AS after
            FROM ({breaching}) WINDOW own AS (PARTITION BY job_name, environment ORDER BY window_start)
        ), latest AS (SELECT max(time_bucket(INTERVAL 5 MINUTE, ts)) AS latest FROM events)
        SELECT window_end AS changed_at, job_name, environment, 'ALARM' AS state FROM marked
        WHERE before IS NULL OR before < window_start
        UNION ALL
        SELECT window_end + INTERVAL 5 MINUTE, job_name, environment, 'OK' FROM marked, latest
        WHERE (after IS NULL OR after > window_end) AND window_end + INTERVAL 5 MINUTE <= latest"""


def _products_sanity(rows):
    return f"""
        SELECT count(*) AS total_products, count(DISTINCT product_id) AS unique_products,
               CAST(COALESCE(sum(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)
                   AS null_pks,
               count(DISTINCT department) AS department_count
        FROM ({rows})"""


def _orders_sanity(rows):
    return f"""
        SELECT count(*) AS total_orders, count(DISTINCT order_id) AS unique_orders,
               CAST(COALESCE(sum(CASE WHEN total_amount <= 0 THEN 1 ELSE 0 END), 0) AS BIGINT)
                   AS invalid_amounts,
               min(order_timestamp) AS earliest_order, max(order_timestamp) AS latest_order
        FROM ({rows})"""


def _ri_audit(items):
    return f"""
        SELECT count(*) AS orphaned_order_items
        FROM ({items}) oi LEFT JOIN ({ORDERS}) o ON oi.order_id = o.order_id
        WHERE o.order_id IS NULL"""


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["products_sanity"] = _products_sanity(PRODUCTS)
    sql["products_sanity_spoiled"] = _products_sanity(SPOILED_PRODUCTS)
    sql["orders_sanity"] = _orders_sanity(ORDERS)
    sql["orders_sanity_spoiled"] = _orders_sanity(SPOILED_ORDERS)
    sql["ri_audit"] = _ri_audit(ORDER_ITEMS)
    sql["ri_audit_spoiled"] = sql["ri_audit_bitmap"] = _ri_audit(SPOILED_ORDER_ITEMS)
    sql["products_sanity_incremental"] = sql["products_sanity_spoiled"]
    sql["orders_sanity_incremental"] = sql["orders_sanity_spoiled"]

    _pair("not_null", SPOILED_ORDERS, "order_id IS NULL", NULL_REASON.format("order_id"), sql)
    _unique_pair("unique", ORDER_ITEMS, ["id"], ITEM_COLUMNS, sql)
    _unique_pair(
        "unique_pair",
        ORDER_ITEMS,
        ["product_id", "add_to_cart_order"],
        ITEM_COLUMNS,
        sql,
        leading=["order_timestamp"],
    )
    _unique_pair("unique_hot_key", ORDER_ITEMS, ["reordered"], ITEM_COLUMNS, sql)
    _pair("fk", SPOILED_ORDER_ITEMS, FK_FAILS, FK_REASON, sql)
    _pair("fk_bitmap", SPOILED_ORDER_ITEMS, FK_FAILS, FK_REASON, sql)
    _pair("ts_range", SPOILED_ORDERS, TS_FAILS, TS_REASON, sql)
    _pair(
        "positive",
        "SELECT * FROM customer",
        "NOT COALESCE(c_acctbal > 0, FALSE)",
        "'c_acctbal' must be > 0",
        sql,
    )
    _pair("flag", SPOILED_ORDER_ITEMS, FLAG_FAILS, "'reordered' must be 0 or 1", sql)

    part_columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    custom = [
        ("", NULL_REASON.format("p_partkey"), "p_partkey IS NULL"),
        ("", "costs over 1500", "NOT COALESCE(p_retailprice <= 1500, FALSE)"),
        ("", "duplicate key on columns: ['p_name', 'p_brand']", ["p_name", "p_brand"]),
    ]
    sql["custom_rule_rejects"] = _chain("SELECT * FROM part", custom, part_columns) + _rejects(
        custom
    )

    own_rules = [
        ("", "duplicate key on columns: ['p_name', 'p_brand']", ["p_name", "p_brand"]),
        ("", "costs over 1500", "NOT COALESCE(p_retailprice <= 1500, FALSE)"),
        ("", "larger than 40", "NOT COALESCE(p_size <= 40, FALSE)"),
    ]
    sql["custom_rules_chain"] = _chain("SELECT * FROM part", own_rules, part_columns) + _rejects(
        own_rules
    )

    gates = []
    for name, (rows, steps, columns) in CHAINS.items():
        chain = _chain(rows, steps, columns)
        sql[f"{name}_validate_rejects"] = chain + _rejects(steps)
        sql[f"{name}_validate_valid"] = chain + f"SELECT * FROM alive{len(steps)}"
        sql[f"{name}_rule_results"] = chain + _results(steps)
        sql[f"{name}_validation_summary"] = chain + _summary(steps)
        gates.append(
            f"SELECT '{name}' AS table_name, failure_ratio, failure_ratio > 0.05 AS over_limit "
            f"FROM ({chain + _summary(steps)})"
        )
    for side in ("valid", "invalid"):
        sql[f"rule_unique_default_hot_{side}"] = sql[f"rule_unique_hot_key_{side}"]
    sql["rule_unique_look_ahead_valid"] = sql["rule_unique_valid"]
    sql["order_items_look_ahead_rejects"] = sql["order_items_validate_rejects"]
    sql["order_items_bitmap_rejects"] = sql["order_items_validate_rejects"]
    sql["threshold_gate_report"] = "\nUNION ALL\n".join(gates)

    known = f"EXISTS (SELECT 1 FROM ({ORDERS}) o WHERE o.order_id = t.order_id)"
    sql["join_anti_orphans"] = f"SELECT * FROM ({SPOILED_ORDER_ITEMS}) t WHERE NOT {known}"
    sql["join_semi_known"] = f"SELECT * FROM ({SPOILED_ORDER_ITEMS}) t WHERE {known}"
    sql["join_anti_orphans_bitmap"] = sql["join_anti_orphans"]
    sql["join_semi_known_bitmap"] = sql["join_semi_known"]

    sql["merge_upsert_result"] = f"{MERGE_SIDES} SELECT {_MERGED}, {_ACTION} AS action FROM {_FULL}"
    sql["merge_upsert_rows"] = f"{MERGE_SIDES} SELECT {_MERGED} FROM {_FULL}"
    sql["merge_upsert_counts"] = f"""{MERGE_SIDES}
        SELECT count(*) FILTER (WHERE t.order_id IS NULL) AS rows_inserted,
               count(*) FILTER (WHERE t.order_id = s.order_id) AS rows_updated,
               count(*) FILTER (WHERE s.order_id IS NULL) AS rows_unchanged
        FROM {_FULL}"""
    sql["merge_touched_partitions"] = f"""{MERGE_SIDES}
        SELECT DISTINCT date FROM target WHERE order_id IN (SELECT order_id FROM source)"""

    sql["table_merge_read"] = CUSTOMERS_MOVED
    sql["table_merge_first_version"] = "SELECT * FROM customer"
    sql["table_merge_counts"] = """
        SELECT CAST(1 AS BIGINT) AS version, count(*) AS rows_inserted,
               CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_unchanged FROM customer
        UNION ALL
        SELECT CAST(2 AS BIGINT), CAST(0 AS BIGINT), count(*) FILTER (WHERE c_acctbal <= 0),
               count(*) FILTER (WHERE NOT COALESCE(c_acctbal <= 0, FALSE)) FROM customer"""
    sql["table_bucketed_read"] = CUSTOMERS_MOVED
    sql["table_merge_ledger"] = (
        f"SELECT version, CAST(NULL AS VARCHAR) AS batch_id, rows_inserted, rows_updated, rows_unchanged "
        f"FROM ({sql['table_merge_counts']})"
    )
    sql["table_touched_pruned"] = f"""
        SELECT date, count(*) AS orders FROM ({ORDERS})
        WHERE date < DATE '1999-01-01' AND order_id % 50 = 0 GROUP BY date"""
    sql["schema_drift"] = "SELECT 'party' AS \"column\", 'added' AS change, 'string' AS data_type"
    sql["schema_followed_rows"] = f"""
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS party
        FROM ({CUSTOMERS_MOVED})
        UNION ALL
        SELECT -s_suppkey, s_name, NULL, s_acctbal, 'SUPPLY', 'supplier' FROM supplier"""
    sql["table_registered_sql"] = (
        f"SELECT c_mktsegment, count(*) AS customers, min(c_acctbal) AS lowest "
        f"FROM ({CUSTOMERS_MOVED}) GROUP BY c_mktsegment"
    )

    products_chain = _chain(SPOILED_PRODUCTS, PRODUCT_STEPS, PRODUCT_COLUMNS)
    sql["jobs_summary"] = products_chain + f"""
        SELECT 1 AS run, total, valid, rejected, valid AS inserted, CAST(0 AS BIGINT) AS updated
        FROM ({_JOB_COUNTS})
        UNION ALL
        SELECT 2, total, valid, rejected, CAST(0 AS BIGINT), valid FROM ({_JOB_COUNTS})"""
    sql["jobs_metrics"] = products_chain + f"""
        SELECT 'query-job' AS job_name, 'test' AS environment, total AS records_in,
               valid AS records_valid, rejected AS records_rejected, valid AS rows_inserted,
               CAST(0 AS BIGINT) AS rows_updated
        FROM ({_JOB_COUNTS})"""
    sql["replay_metrics"] = sql["jobs_metrics"]
    sql["gate_keeps_table"] = sql["products_validate_valid"]
    sql["gate_keeps_rejects"] = (
        f"SELECT * REPLACE (upper(product_name) AS product_name) FROM ({sql['products_validate_rejects']})"
    )
    sql["stream_products_load"] = sql["products_validate_valid"]
    sql["stream_retried_rejects"] = sql["products_validate_rejects"]
    sql["jobs_orders_table"] = sql["orders_validate_valid"]
    loaded = f"EXISTS (SELECT 1 FROM ({sql['orders_validate_valid']}) o WHERE o.order_id = t.order_id)"
    steps = [(n, r, f"NOT {loaded}" if f == FK_FAILS else f) for n, r, f in ITEM_STEPS]

    def items_of(rows):
        return _chain(rows, steps, ITEM_COLUMNS) + f"SELECT * FROM alive{len(steps)}"

    def orders_of(rows):
        return _chain(rows, ORDER_STEPS, ORDER_COLUMNS) + f"SELECT * FROM alive{len(ORDER_STEPS)}"

    def rerun(build_valid, rows, key):
        moved = build_valid(
            "SELECT * REPLACE (CAST(date + INTERVAL 1 DAY AS DATE) AS date) "
            f"FROM ({rows}) WHERE order_id % 10 = 0"
        )
        return (
            f"SELECT * FROM ({build_valid(rows)}) WHERE {key} NOT IN (SELECT {key} FROM ({moved})) "
            f"UNION ALL SELECT * FROM ({moved})"
        )

    sql["jobs_order_items_table"] = items_of(SPOILED_ORDER_ITEMS)

    def counts_of(job, rows, valid):
        return (
            f"SELECT '{job}' AS job, total, valid, CAST(total - valid AS BIGINT) AS rejected, valid AS inserted, "
            f"CAST(0 AS BIGINT) AS updated FROM (SELECT (SELECT count(*) FROM ({rows})) AS total, "
            f"(SELECT count(*) FROM ({valid})) AS valid)"
        )

    sql["jobs_all_summaries"] = "\nUNION ALL\n".join(
        [
            "SELECT 'no products' AS job, 0::BIGINT AS total, 0::BIGINT AS valid, 0::BIGINT AS rejected, "
            "0::BIGINT AS inserted, 0::BIGINT AS updated",
            counts_of("products", SPOILED_PRODUCTS, sql["products_validate_valid"]),
            counts_of("orders", SPOILED_ORDERS, sql["orders_validate_valid"]),
            counts_of("order_items", SPOILED_ORDER_ITEMS, sql["jobs_order_items_table"]),
        ]
    )
    sql["jobs_orders_rerun"] = rerun(orders_of, SPOILED_ORDERS, "order_id")
    sql["jobs_order_items_rerun"] = rerun(items_of, SPOILED_ORDER_ITEMS, "id")
    sql["quarantine_rows"] = (
        "SELECT *, 'orders' AS table_name, DATE '2025-01-31' AS run_date, "
        f"'arn_run_2025_01' AS execution_id FROM ({sql['orders_validate_rejects']})"
    )

    sql["csv_scan"] = (
        "SELECT CASE WHEN product_id % 97 = 0 THEN NULL ELSE product_id END AS product_id, "
        f"department_id, department, product_name FROM ({PRODUCTS})"
    )
    sql["listed_files"] = f"SELECT DISTINCT department_id, CAST(1 AS BIGINT) AS files FROM ({PRODUCTS})"
    sql["archived_files"] = PRODUCTS
    sql["json_lines_scan"] = SPOILED_ORDER_ITEMS
    sql["excel_scan"] = SPOILED_ORDERS
    sql["defect_injection"] = SPOILED_ORDERS

    sql["conform_schema"] = """
        SELECT CAST(NULL AS BIGINT) AS order_num, o_orderkey AS order_id,
               TRY_CAST(CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
                             ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS user_id,
               o_totalprice AS total_amount, CAST(o_orderdate AS DATE) AS date
        FROM orders"""
    sql["conform_nan"] = """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS INTEGER) END
                   AS l_quantity
        FROM lineitem"""
    sql["union_by_name_missing"] = """
        SELECT c_custkey AS party_id, c_mktsegment AS segment, c_acctbal AS balance FROM customer
        UNION ALL
        SELECT s_suppkey, NULL, s_acctbal FROM supplier"""
    sql["archive_keys"] = """
        SELECT page_id, 'YYYY=2025/MM=01/DD=31/' ||
               split_part(url_decode(replace(url, '+', ' ')), '/', -1) AS archive_key
        FROM pages"""
    sql["archive_keys_encoded"] = """
        SELECT page_id, 'incoming/page+' || page_id || '+%C3%A9.html' AS key,
               'YYYY=2025/MM=01/DD=31/page ' || page_id || ' é.html' AS archive_key
        FROM pages"""
    sql["file_routing"] = """
        SELECT file_name, ends_with(lower(file_name), '.xlsx') AS is_workbook,
               ends_with(lower(file_name), '.xlsx') AND NOT lower(file_name) LIKE '%order\\_item%'
                   ESCAPE '\\' AS for_orders,
               ends_with(lower(file_name), '.xlsx') AND lower(file_name) LIKE '%order\\_item%'
                   ESCAPE '\\' AS for_items
        FROM (SELECT CASE WHEN p_size % 2 = 0 THEN 'Order_Items_' ELSE 'orders_' END || p_partkey ||
                     CASE p_size % 3 WHEN 0 THEN '.XLSX' WHEN 1 THEN '.xlsx' ELSE '.csv' END
                     AS file_name FROM part)"""
    sql["bucket_names"] = "SELECT p_partkey, lower(p_brand) || '-' || p_partkey AS bucket FROM part"
    sql["execution_ids"] = (
        "SELECT event_id, 'arn_run_' || event_type || '_' || event_id AS execution_id FROM events"
    )

    errors = _windows("level = 'ERROR'", "count(*)", "errors")
    rejects = _windows(
        "records_rejected > 0", "CAST(sum(records_rejected) AS BIGINT)", "records_rejected"
    )
    sql["errors_5m"] = errors
    sql["alarm_errors_5m"] = f"SELECT * FROM ({errors}) WHERE errors >= 1"
    sql["rejects_5m"] = rejects
    sql["alarm_value_spike_5m"] = f"SELECT * FROM ({rejects}) WHERE records_rejected > 100"
    sql["completions_5m"] = _windows("event = 'JOB_COMPLETE'", "count(*)", "completions")
    sql["stream_errors_compacted_5m"] = errors
    sql["alarm_transitions"] = _transitions(sql["alarm_errors_5m"])
    sql["alarm_reject_transitions"] = _transitions(sql["alarm_value_spike_5m"])
    sql["stream_alarm_transitions"] = sql["alarm_transitions"]
    for name in ("errors_5m", "value_spike_5m", "completions_5m"):
        sql[f"stream_{name}"] = sql[name if name in sql else f"alarm_{name}"]
    return sql
