"""Batch data quality and upserts on Spark DataFrames."""
