"""Column functions over file names, object keys and run ids."""

from __future__ import annotations

from datetime import date

import pyspark.sql.functions as F
from pyspark.sql import Column


def safe_execution_id(execution_id: str) -> str:
    """Run id fit for a path: ``:`` and ``/`` become ``_``."""
    return execution_id.translate(str.maketrans(":/", "__"))


def safe_execution_id_column(execution_id: Column) -> Column:
    """The same as safe_execution_id, over a column."""
    return F.translate(execution_id, ":/", "__")


def is_workbook(file_name: Column) -> Column:
    """File names ending in .xlsx, in any case."""
    return F.lower(file_name).endswith(".xlsx")


def is_items_workbook(file_name: Column) -> Column:
    """Workbooks of order items."""
    return is_workbook(file_name) & F.lower(file_name).contains("order_item")


def is_orders_workbook(file_name: Column) -> Column:
    """Workbooks of orders: every workbook that is not one of order items."""
    return is_workbook(file_name) & ~F.lower(file_name).contains("order_item")


def last_segment(key: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(key, "/", -1)


def archive_key(key: Column, day: Column) -> Column:
    """Archive destination of a URL-encoded object key: day folders, then the file name."""
    return F.concat(
        F.date_format(day, "'YYYY='yyyy'/MM='MM'/DD='dd'/'"),
        last_segment(F.coalesce(F.try_url_decode(key), key)),
    )


def archive_folder(day: date) -> str:
    """The day folders of archive_key, for one known day."""
    return f"YYYY={day:%Y}/MM={day:%m}/DD={day:%d}"


def bucket_name(location: Column) -> Column:
    """Location without ``s3://`` and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(location, "^s3://", ""), "/+$", "")
