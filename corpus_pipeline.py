"""Documents to packed training sequences: stages over the operators of sparkgate.llm.

A stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of documents; the
last returns token pieces in their places. Results are written and read again between stages. A
stage works on any docs with those columns, null values, repeated rows and no rows included, as
its operator's docstring tells.
Each row follows its own verdict, by id, which may be null, and text.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from sparkgate.llm import exact, langid, near, packing, secrets
from sparkgate.llm.tables import narrow_enough, stage, table
from sparkgate.sources.staging import StagingArea, staging_scope

# Languages less sure than this are rejected: the chance of a coin toss at each of two choices.
LEAST_SURE = 0.25


def _kept(docs: DataFrame, verdicts: DataFrame, body: Column) -> DataFrame:
    """docs without the rows that are dropped, by id, which may be null, and text.

    verdicts have text_sha256 of body, the text as the verdict takes it. The dropped ids and hashes
    are stored and, if their list is small enough, sent to all tasks.
    """
    dropped = verdicts.filter("NOT kept").select(
        F.col("doc_id").alias("dropped_id"), F.unhex("text_sha256").alias("dropped_sha")
    )
    dropped = stage(dropped.distinct(), "dropped")
    same = F.col("docs.doc_id").eqNullSafe(F.col("gone.dropped_id")) & (
        F.unhex(F.sha2(body, 256)) == F.col("gone.dropped_sha")
    )
    left = docs.alias("docs").join(narrow_enough(dropped, 64).alias("gone"), same, "left_anti")
    return left.select(*[F.col(f"`{name}`") for name in docs.columns])


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts without a letter go, and those of no sure language."""
    found = langid.languages(docs, with_hash=True)
    sure = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SURE)
    return _kept(docs, found.select("doc_id", "text_sha256", sure.alias("kept")), langid.body(F.col("text")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, that with the smallest id."""
    return _kept(docs, exact.exact_duplicates(docs), exact.content(F.col("text")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the smallest id."""
    return _kept(docs, near.near_duplicates(docs, with_hash=True), near.body(F.col("text")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in their texts replaced by a mark of its kind."""
    return secrets.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

# Models, hashed darts and packing are not expressible in SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage stores on its way goes once its result is written."""
    docs = table(spark, sf_dir, "documents")
    written = StagingArea(spark, "pipeline")
    before = None
    for name, step in STAGES[:-1]:
        with staging_scope():
            docs = written.write(step(spark, docs, sf_dir), name)
        if before:
            written.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
