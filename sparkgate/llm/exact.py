"""Exact duplicates: 128-bit content hashes, smallest id stays, bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from sparkgate.llm.tables import SLICE_ROWS, narrow_enough, repeated_groups, salt, stage

SPACES = r"[\x20\x09-\x0D]+"


def content(text: Column) -> Column:
    """Text with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def hash128(text: Column) -> Column:
    """The 128-bit content hash."""
    return F.unhex(F.md5(text))


def exact_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    digest: Callable[[Column], Column] = hash128,
) -> DataFrame:
    """One row per row of documents: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by a 128-bit hash of their normalised text, narrow rows only. Of groups with
    more than one row, and only of these, texts are read again and compared with that of the row
    that stays, in slices, so that a hot group's rows meet copies of one text in many tasks. Rows
    that share the hash but not the bytes form groups by their text itself.

    Null text counts as empty. A null id is larger than any other, and stays only in a group that
    has no other. Rows that repeat an id and its text are one document, and share its verdict; all
    of them count in group_size. Other columns are not read, whatever their names. No rows, no
    result rows.
    """
    texts = documents.select(
        F.col(f"`{id_col}`").alias("doc_id"), content(F.col(f"`{text_col}`")).alias("body")
    ).withColumn("h", digest(F.col("body")))
    rows = stage(
        texts.select("doc_id", "h", F.sha2("body", 256).alias("text_sha256"), salt("doc_id").alias("salt")),
        "digests",
    )
    groups = stage(repeated_groups(rows, ["h"], "doc_id"), "groups")
    members = stage(
        rows.join(groups, ["h", "salt"]).select("doc_id", "h", "keep_id", "group_size"), "members"
    )
    strays = stage(_unlike_their_keeper(texts, members), "strays")
    labelled = rows.join(groups, ["h", "salt"], "left")
    if not strays.isEmpty():
        labelled = _set_apart(labelled, strays)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return labelled.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def _unlike_their_keeper(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Members whose bytes differ from their group's keeper: doc_id, h, keep_id, body."""
    slices = F.ceil(F.col("group_size") / SLICE_ROWS).cast("int")
    known = narrow_enough(
        members.select(
            F.col("doc_id").alias("member_id"), F.col("h").alias("member_h"), "keep_id", slices.alias("slices")
        ).distinct(),
        64,
    )
    bodies = texts.join(
        known,
        F.col("doc_id").eqNullSafe(F.col("member_id")) & (F.col("h") == F.col("member_h")),
    ).select("doc_id", "h", "keep_id", "slices", "body")
    keepers = (
        bodies.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("h", "slices")
        .agg(F.min("body").alias("keeper_body"))
        .select("h", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "keeper_body")
    )
    sliced = bodies.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.col("slices")).cast("int"))
    return (
        sliced.join(keepers, ["h", "slice"])
        .filter(F.col("body") != F.col("keeper_body"))
        .select("doc_id", "h", "keep_id", "body")
    )


def _set_apart(labelled: DataFrame, strays: DataFrame) -> DataFrame:
    """labelled with rows that collided under the hash in groups by their own text."""
    own = strays.groupBy("h", "body").agg(
        F.min("doc_id").alias("own_keep"), F.count(F.lit(1)).alias("own_size")
    )
    placed = (
        strays.join(own, ["h", "body"])
        .groupBy(F.col("doc_id").alias("stray_id"), F.col("h").alias("stray_h"), F.sha2("body", 256).alias("stray_sha"))
        .agg(F.first("own_keep").alias("own_keep"), F.first("own_size").alias("own_size"))
    )
    gone = strays.groupBy(F.col("h").alias("gone_h")).agg(F.count(F.lit(1)).alias("gone"))
    stray = F.col("stray_h").isNotNull()
    return (
        labelled.join(
            placed,
            F.col("doc_id").eqNullSafe(F.col("stray_id"))
            & (F.col("h") == F.col("stray_h"))
            & (F.col("text_sha256") == F.col("stray_sha")),
            "left",
        )
        .join(gone, F.col("h") == F.col("gone_h"), "left")
        .select(
            "doc_id",
            "text_sha256",
            F.when(stray, F.col("own_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(stray, F.col("own_size"))
            .otherwise(F.col("group_size") - F.coalesce("gone", F.lit(0)))
            .alias("group_size"),
        )
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
