"""Table schemas, keys and partition columns.

Every table has two schemas. Raw input is read as all-nullable: on a column declared non-null
Catalyst folds ``isNull`` to false, which would silence the null rules. The declared (target)
nullability is checked on the surviving rows, just before they are merged.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.IntegerType(), False),
        T.StructField("department_id", T.IntegerType(), False),
        T.StructField("department", T.StringType(), False),
        T.StructField("product_name", T.StringType(), False),
    ]
)

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("order_num", T.LongType(), True),
        T.StructField("order_id", T.IntegerType(), False),
        T.StructField("user_id", T.IntegerType(), False),
        T.StructField("order_timestamp", T.TimestampType(), False),
        T.StructField("total_amount", T.DoubleType(), False),
        T.StructField("date", T.DateType(), False),
    ]
)

ORDER_ITEMS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("order_id", T.IntegerType(), False),
        T.StructField("user_id", T.IntegerType(), True),
        T.StructField("days_since_prior_order", T.IntegerType(), True),
        T.StructField("product_id", T.IntegerType(), False),
        T.StructField("add_to_cart_order", T.IntegerType(), True),
        T.StructField("reordered", T.IntegerType(), False),
        T.StructField("order_timestamp", T.TimestampType(), False),
        T.StructField("date", T.DateType(), True),
    ]
)

SCHEMA_REGISTRY = {
    "products": PRODUCTS_SCHEMA,
    "orders": ORDERS_SCHEMA,
    "order_items": ORDER_ITEMS_SCHEMA,
}

PRIMARY_KEYS = {
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["id"],
}

PARTITION_COLS = {
    "products": [],
    "orders": ["date"],
    "order_items": ["date"],
}


def raw_schema(schema: T.StructType) -> T.StructType:
    """The same columns, all nullable: the schema to read landing files with."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def required_columns(schema: T.StructType) -> list[str]:
    """Columns the target declares non-null."""
    return [f.name for f in schema.fields if not f.nullable]
