"""Links between the rows of large groups of variants, without comparing all pairs of a group.

Sets are written as what sets them apart from a centre of their group. Two of them are alike if
these differences are small, or share enough: which a prefix join on their rarest elements finds.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from sparkgate.llm.components import components
from sparkgate.llm.tables import Scratch, narrow_enough

# Allowance for rounding when sizes are compared.
_SLACK = 1e-6


def _grouped(apart: DataFrame, elements: DataFrame) -> DataFrame:
    """node, class_id, group, size and elements: rows connected by buckets form a group."""
    low = apart.groupBy("bucket").agg(F.min("node").alias("a"))
    groups = components(apart.join(low, "bucket").select("a", F.col("node").alias("b")))
    nodes = apart.select("node", "class_id").distinct()
    return nodes.join(groups.withColumnRenamed("class_id", "group"), "node").join(elements, "node")


def _differences(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows with delta, the elements that are in either the row or its group's centre, not in both.

    The centre holds what more than half of the group's rows hold, so it is no larger than twice
    their mean size.
    """
    held = rows.select("group", F.explode("elements").alias("element")).groupBy("group", "element").count()
    totals = scratch.stage(rows.groupBy("group").agg(F.count(F.lit(1)).alias("rows")), "totals")
    # Sent to all tasks if there are few groups, so that a large group's elements stay spread.
    most = held.join(narrow_enough(totals, 16), "group").filter(2 * F.col("count") > F.col("rows"))
    centres = most.groupBy("group").agg(F.collect_list("element").alias("centre"))
    centre = F.coalesce("centre", F.array().cast("array<long>"))
    return rows.join(centres, "group", "left").select(
        "node", "class_id", "group", "size",
        F.concat(F.array_except("elements", centre), F.array_except(centre, "elements")).alias("delta"),
    )


def spread_links(apart: DataFrame, elements: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """Links a, b that connect all rows of a group that are alike and of different classes.

    apart has node, bucket and class_id, elements node, size and elements, see near. Let D be a
    row's difference from the centre. x and y are alike exactly if |x ^ y| <= gap (|x| + |y|), and
    x ^ y = Dx ^ Dy. With excess = |D| - gap |x|:

    - if the excesses of x and y add up to 0 or less, they are alike. So are then both of them and
      the row of least excess in the group, to which they are linked without a look;
    - otherwise they are alike only if Dx and Dy share (excess x + excess y) / 2 elements, one at
      least. With both sorted alike, rarest first, one of these lies near the start of either.
      Rows meet on such elements, and are checked exactly.

    Elements that only one class holds can link nothing; they count as the rarest.
    """
    gap = (1 - least) / (1 + least)
    grouped = scratch.stage(_grouped(apart, elements), "groups")
    rows = scratch.stage(_differences(grouped, scratch), "differences")
    judged = rows.select(
        "node", "class_id", "group", "size", F.size("delta").alias("n"), (F.size("delta") - gap * F.col("size")).alias("excess")
    )
    nearest = scratch.stage(judged.groupBy("group").agg(F.min(F.struct("excess", "node")).alias("least")), "nearest")
    judged = judged.join(narrow_enough(nearest, 48), "group").withColumn("close", F.col("excess") + F.col("least.excess") <= _SLACK)
    close = judged.filter("close AND node <> least.node").select(F.col("least.node").alias("a"), F.col("node").alias("b"))

    held = rows.select("group", "node", "class_id", F.explode("delta").alias("element"))
    shared = held.groupBy("group", "element").agg(
        F.min("class_id").alias("low"), F.max("class_id").alias("high"), F.count(F.lit(1)).alias("holders")
    )
    shared = scratch.stage(shared.filter("low <> high").select("group", "element", "holders"), "shared_elements")
    common = held.join(shared, ["group", "element"]).join(judged.drop("class_id", "least"), ["node", "group"])
    own = Window.partitionBy("node")
    place = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("holders", "element")) - 1
    # Whatever the partner, as many elements must be shared that none of them lies further on.
    starts = common.withColumn("place", place).filter(F.col("place") <= gap * (1 + 1 / least) * F.col("size") + _SLACK)
    starts = scratch.stage(
        starts.select("group", "element", "node", "class_id", "size", "n", "excess", "close", "place"), "starts"
    )
    x, y = (starts.select("group", "element", *[F.col(c).alias(f"{c}_{side}") for c in starts.columns[2:]]) for side in "ab")
    needed = F.greatest(F.lit(1), F.ceil((F.col("excess_a") + F.col("excess_b")) / 2 - _SLACK))
    may = (
        (F.col("node_a") < F.col("node_b")) & (F.col("class_id_a") != F.col("class_id_b"))
        & ~(F.col("close_a") & F.col("close_b"))
        & (F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * least - _SLACK)
        & (F.col("place_a") <= F.col("n_a") - needed) & (F.col("place_b") <= F.col("n_b") - needed)
    )
    meeting = x.join(y, ["group", "element"]).filter(may)
    pairs = scratch.stage(meeting.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "meeting")
    first = rows.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("delta").alias("delta_a"))
    second = rows.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("delta").alias("delta_b"))
    apart_by = F.size("delta_a") + F.size("delta_b") - 2 * F.size(F.array_intersect("delta_a", "delta_b"))
    alike = apart_by <= gap * (F.col("size_a") + F.col("size_b")) + _SLACK
    checked = pairs.join(first, "a").join(second, "b").filter(alike).select("a", "b")
    links = scratch.stage(close.union(checked), "spread_links")
    scratch.drop("groups", "totals", "differences", "nearest", "shared_elements", "starts", "meeting")
    return links
