"""The given star-schema tables seen as products, orders, order items and run events.

The clean views only rename. The spoiled views add deterministic defects for the rules to find.
Keys stay 64-bit, as they are in the files: at large scale they pass the 32-bit range.
"""

from __future__ import annotations

from datetime import datetime

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from sparkgate.functions.defects import inject_defects

# Range the mapped timestamps are checked against; a few real rows fall outside.
MIN_TS = datetime(1995, 6, 1)
MAX_TS = datetime(2001, 6, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_size").alias("department_id"),
        F.col("p_type").alias("department"),
        F.col("p_name").alias("product_name"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_num"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").cast("date").alias("date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("user_id"),
        F.when(F.col("l_linenumber") > 1, F.col("l_quantity").cast("int")).alias(
            "days_since_prior_order"
        ),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
        (F.col("l_returnflag") == "R").cast("int").alias("reordered"),
        F.col("l_shipdate").alias("order_timestamp"),
        F.col("l_shipdate").cast("date").alias("date"),
    )


def _old_timestamp() -> Column:
    return F.lit("1990-01-01 00:00:00").cast("timestamp_ntz")


def spoiled_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = F.lit(None)
    return inject_defects(
        products(spark, sf_dir),
        "product_id",
        {
            "product_id": [(97, null)],
            "department": [(89, null)],
            "product_name": [(83, null)],
        },
        duplicate_every=71,
    )


def spoiled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = F.lit(None)
    return inject_defects(
        orders(spark, sf_dir),
        "order_num",
        {
            "order_id": [(97, null)],
            "user_id": [(73, null)],
            "order_timestamp": [(101, null), (79, _old_timestamp())],
            "total_amount": [(89, -F.col("total_amount")), (83, F.lit(0.0))],
        },
        duplicate_every=71,
    )


def spoiled_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = F.lit(None)
    return inject_defects(
        order_items(spark, sf_dir),
        "order_id",
        {
            "id": [(97, null)],
            "order_id": [(103, null), (89, F.col("order_id") + 1_000_000_000_000)],
            "product_id": [(101, null)],
            "reordered": [(83, F.lit(2))],
            "order_timestamp": [(79, _old_timestamp())],
        },
    )


def run_events(events: DataFrame) -> DataFrame:
    """Application events as if they were run events of three jobs."""
    kind = F.col("event_type")
    return events.select(
        "ts",
        F.when(kind == "error", "ERROR").otherwise("INFO").alias("level"),
        F.when(kind == "purchase", "JOB_COMPLETE").otherwise(F.upper(kind)).alias("event"),
        F.when(F.col("user_id") % 3 == 0, "products-etl")
        .when(F.col("user_id") % 3 == 1, "orders-etl")
        .otherwise("order-items-etl")
        .alias("job_name"),
        F.when(F.col("user_id") % 5 == 0, "test").otherwise("dev").alias("environment"),
        F.when(kind == "purchase", F.floor("value")).alias("records_rejected"),
    )


# The merge example: orders known so far, and a later delivery that overlaps them, with amounts
# and dates corrected.
FIRST_DELIVERY_ENDS = "1999-01-01"
SECOND_DELIVERY_STARTS = "1997-01-01"


def known_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).filter(F.col("date") < F.lit(FIRST_DELIVERY_ENDS).cast("date"))


def delivered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir)
    return (
        rows.filter(F.col("date") >= F.lit(SECOND_DELIVERY_STARTS).cast("date"))
        .withColumn("total_amount", F.col("total_amount") + 1.0)
        .withColumn("date", F.date_add("date", 1))
    )
