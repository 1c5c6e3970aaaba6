"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from sparkgate.sources.staging import StagingArea

MOST_ROUNDS = 60


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """node and class_id, the smallest node of its component, of every node with a link.

    Alternates two steps until the links are stars: each node hands its larger neighbours, then its
    smaller ones, to the smallest it knows. Rounds grow with the logarithm of the longest path. Each
    is stored, and the one before removed; smallest neighbours are combined map-side, and joins of
    hot nodes are split by adaptive execution. Links of a node to itself are passed over.
    """
    spark = links.sparkSession
    area = StagingArea(spark, "llm-components")
    edges = links.select(
        F.least(first, second).alias("low"), F.greatest(first, second).alias("high")
    ).filter("low <> high")
    edges = area.write(edges.distinct(), "links_0")
    seen = None
    for turn in range(1, MOST_ROUNDS + 1):
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).union(
            edges.select(F.col("high").alias("u"), F.col("low").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("m").alias("low"), F.col("v").alias("high"))
        large = large.filter("low <> high").distinct()
        under = large.groupBy("high").agg(F.min("low").alias("m"))
        hung = large.join(under, "high")
        small = hung.select(F.col("m").alias("low"), F.col("low").alias("high")).union(
            hung.select(F.col("m").alias("low"), "high")
        )
        edges = area.write(small.filter("low <> high").distinct(), f"links_{turn}")
        area.drop(f"links_{turn - 1}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("high").alias("node"), F.col("low").alias("class_id")).union(
        edges.select(F.col("low").alias("node"), F.col("low").alias("class_id")).distinct()
    )
