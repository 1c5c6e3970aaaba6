import hashlib
import re
from collections import defaultdict

import pyspark.sql.functions as F

from sparkgate.llm import exact


def by_hand(rows):
    norm = [(i, re.sub("[ \t-\r]+", " ", t or "")) for i, t in rows]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        (
            (i, keep[t], len(groups[t]), i == keep[t], hashlib.sha256(t.encode()).hexdigest())
            for i, t in norm
        ),
        key=str,
    )


def result(frame):
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, frame.select(names).collect()), key=str)


def rows_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_odd_rows(odd):
    assert result(exact.exact_duplicates(odd)) == by_hand(rows_of(odd))


def test_no_rows(none):
    assert result(exact.exact_duplicates(none)) == []


def test_given_rows(given):
    docs = given("documents")
    assert result(exact.exact_duplicates(docs)) == by_hand(rows_of(docs))


def test_collisions_are_told_apart_by_bytes(odd, given):
    weak = lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))
    for docs in (odd, given("documents").select("doc_id", "text")):
        assert result(exact.exact_duplicates(docs, digest=weak)) == by_hand(rows_of(docs))


def test_a_large_group_is_compared_in_slices(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same  text").alias("text"))
    found = exact.exact_duplicates(docs)
    assert found.filter("kept").count() == 1
    assert {tuple(r) for r in found.select("keep_id", "group_size").distinct().collect()} == {(0, 3000)}
