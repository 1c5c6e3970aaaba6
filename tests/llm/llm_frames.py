"""Frames of documents, with columns whose names the operators use inside."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "h string, salt int, keep_id string, found string, `a.b` int"
)


def documents(spark, rows):
    """Documents with these (doc_id, text, lang)."""
    full = [(i, t, g, "s", len(t) if t else 0, "x", 7, "y", "z", 1) for i, t, g in rows]
    return spark.createDataFrame(full, SCHEMA)
