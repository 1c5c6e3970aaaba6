"""The sanity and integrity audits, as SQL text over any three frames."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from sparkgate.functions.names import safe_execution_id
from sparkgate.operators.key_bitmap import key_bitmaps, key_count, merged_bitmaps, orphan_rows
from sparkgate.sources.staging import StagingArea


def products_sanity(products: DataFrame) -> DataFrame:
    """Row, key, null-key and department counts."""
    return products.sparkSession.sql(
        """
        SELECT count(*)                                 AS total_products,
               count(DISTINCT product_id)               AS unique_products,
               count_if(product_id IS NULL)             AS null_pks,
               count(DISTINCT department)               AS department_count
        FROM {products}
        """,
        products=products,
    )


def orders_sanity(orders: DataFrame) -> DataFrame:
    """Row and key counts, amounts that are not positive, and the time span."""
    return orders.sparkSession.sql(
        """
        SELECT count(*)                      AS total_orders,
               count(DISTINCT order_id)      AS unique_orders,
               count_if(total_amount <= 0)   AS invalid_amounts,
               min(order_timestamp)          AS earliest_order,
               max(order_timestamp)          AS latest_order
        FROM {orders}
        """,
        orders=orders,
    )


def orphaned_order_items(order_items: DataFrame, orders: DataFrame, *, dense_keys: bool = False) -> DataFrame:
    """Number of items whose order does not exist, null order ids included.

    Items are counted per order id before the join, so a hot id is one row by then. With dense_keys
    the order ids, which must be integers, are taken as bitmaps.
    """
    per_order = order_items.groupBy("order_id").agg(F.count(F.lit(1)).alias("items"))
    if dense_keys:
        orphans = orphan_rows(per_order, "order_id", key_bitmaps(orders, "order_id"))
    else:
        orphans = per_order.join(orders.select("order_id"), "order_id", "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("items"), F.lit(0).cast("bigint")).alias("orphaned_order_items")
    )


class AuditState:
    """Audits over deliveries, each of which is read once.

    A delivery leaves what it adds to the audit: totals, its keys as bitmaps, and its distinct texts.
    All of these can be put together exactly, so the audit reads them and no delivery again. A
    delivery that comes again replaces what it left. Keys must be integers that lie close together.
    """

    def __init__(self, path: str) -> None:
        self._path = path.rstrip("/")

    def _keep(self, part: DataFrame, name: str, delivery: str) -> None:
        part.write.mode("overwrite").parquet(f"{self._path}/{name}/delivery={safe_execution_id(delivery)}")

    def _kept(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self._path}/{name}").drop("delivery")

    def add_products(self, products: DataFrame, delivery: str) -> None:
        """Keep what a delivery of products adds."""
        with StagingArea(products.sparkSession, "audit") as staging:
            rows = staging.write(products.select("product_id", "department"), "rows")
            self._keep(
                rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("product_id").isNull()).alias("nulls")),
                "totals", delivery,
            )
            self._keep(key_bitmaps(rows, "product_id"), "keys", delivery)
            self._keep(rows.select("department").filter("department IS NOT NULL").distinct(), "departments", delivery)

    def products_sanity(self, spark: SparkSession) -> DataFrame:
        """products_sanity() over all deliveries."""
        totals = self._kept(spark, "totals").agg(
            F.coalesce(F.sum("total"), F.lit(0)).alias("total_products"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_pks")
        )
        keys = merged_bitmaps(self._kept(spark, "keys"))
        departments = self._kept(spark, "departments").distinct().agg(F.count(F.lit(1)))
        unique = keys.agg(key_count())
        return totals.select(
            "total_products", unique.scalar().alias("unique_products"), "null_pks",
            departments.scalar().alias("department_count"),
        )

    def add_orders(self, orders: DataFrame, delivery: str) -> None:
        """Keep what a delivery of orders adds."""
        with StagingArea(orders.sparkSession, "audit") as staging:
            rows = staging.write(orders.select("order_id", "total_amount", "order_timestamp"), "rows")
            totals = rows.agg(
                F.count(F.lit(1)).alias("total"), F.count_if(F.col("total_amount") <= 0).alias("invalid"),
                F.min("order_timestamp").alias("earliest"), F.max("order_timestamp").alias("latest"),
            )
            self._keep(totals, "totals", delivery)
            self._keep(key_bitmaps(rows, "order_id"), "keys", delivery)

    def orders_sanity(self, spark: SparkSession) -> DataFrame:
        """orders_sanity() over all deliveries."""
        totals = self._kept(spark, "totals").agg(
            F.coalesce(F.sum("total"), F.lit(0)).alias("total_orders"), F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_amounts"),
            F.min("earliest").alias("earliest_order"), F.max("latest").alias("latest_order"),
        )
        keys = merged_bitmaps(self._kept(spark, "keys"))
        unique = keys.agg(key_count()).scalar().alias("unique_orders")
        return totals.select("total_orders", unique, "invalid_amounts", "earliest_order", "latest_order")
