"""Schema-conforming projection and by-name unions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.schemas import raw_schema


def _fit(df: DataFrame, field: T.StructField, loose_numbers: bool) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)

    column = F.col(f"`{field.name}`")
    source_type = df.schema[field.name].dataType
    if source_type == field.dataType:
        return column
    if isinstance(source_type, (T.DoubleType, T.FloatType)) and isinstance(
        field.dataType, T.IntegralType
    ):
        # A NaN is a missing integer, not a zero.
        column = F.when(~F.isnan(column), column)
    fitted = column.try_cast(field.dataType)
    if (
        loose_numbers
        and isinstance(source_type, T.StringType)
        and isinstance(field.dataType, T.IntegralType)
    ):
        fitted = F.coalesce(fitted, column.try_cast("double").try_cast(field.dataType))
    return fitted.alias(field.name)


def conform(df: DataFrame, schema: T.StructType, *, loose_numbers: bool = False) -> DataFrame:
    """Project df onto schema: its columns, types and order; absent columns become typed nulls.

    A value that does not fit its type becomes null, for a null rule to catch. With
    loose_numbers, text such as ``12.5`` or ``1E3`` still fills an integer column, as spreadsheet
    cells need.
    """
    return df.select([_fit(df, field, loose_numbers) for field in schema.fields])


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A frame of the schema's columns with no rows."""
    return spark.createDataFrame([], raw_schema(schema))


def union_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column a frame lacks is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
