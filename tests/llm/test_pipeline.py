"""The registered queries against their SQL, and the pipeline against brute force."""

import re

import pytest

import __spark_entry__
import corpus_pipeline
from llm_frames import documents
from oracle import connect, differences
from sparkgate.llm import queries, secrets
from test_near import by_hand as classes_by_hand
from test_packing import sound

from conftest import SF_DIR  # noqa: E402


def test_names():
    found = __spark_entry__.queries()
    assert "pipeline" in found
    assert sorted({int(n[2:].split("_")[0]) for n in found if re.match(r"op\d+_", n)}) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, given, name):
    given("documents")
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE_SQL[name]) == ""


def _kept_by_hand(rows):
    """Rows (id, text) that come out of the four filtering stages, with their texts as changed."""
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    first = {}
    for i, t in sorted(rows):
        first.setdefault(re.sub("[ \t-\r]+", " ", t), i)
    rows = [(i, t) for i, t in rows if i in first.values()]
    keep = classes_by_hand(rows)
    out = []
    for i, t in rows:
        if keep[i] == i:
            spans = sorted(
                (m.start(), n, m.end())
                for n, rule in enumerate(secrets.RULES)
                for m in re.finditer(rule.pattern, t, re.ASCII)
                if len(m.group(rule.group)) >= rule.least
            )
            at, clean = 0, ""
            for a, n, b in spans:
                clean += t[at:a] + (f"[{secrets.RULES[n].kind}]" if a >= at else "")
                at = max(at, b)
            out.append((i, clean + t[at:]))
    return sorted(out)


def test_stages_against_brute_force(spark, given):
    docs = source = given("documents")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF_DIR)
        assert docs.columns == source.columns and docs.dtypes == source.dtypes
    found = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert found == _kept_by_hand([(r.doc_id, r.text) for r in source.select("doc_id", "text").collect()])
    assert all(r.n_chars == len(r.text) for r in docs.collect())


def test_run(spark, given):
    given("documents")
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sound(rows) > 0


def test_odd_documents(spark, odd, none):
    for docs, most in ((odd, odd.count()), (none, 0), (documents(spark, [(1, None, None)]), 0)):
        for _, step in corpus_pipeline.STAGES[:-1]:
            docs = step(spark, docs, SF_DIR)
        assert docs.count() <= most
        # Rows without an id can't be named, and stay.
        assert docs.filter("doc_id IN (1, 2, 3, 9)").count() == 0
        corpus_pipeline.pack_sequences(spark, docs, SF_DIR).count()


def test_each_row_follows_its_own_verdict(spark):
    prose = "several plain words that stand in the first of all these texts"
    other = "another quite different sentence about rivers and their bridges"
    third = "nothing here is like the rest since kitchens have tables and chairs"
    loose = f" \t{third}\n\n"
    docs = documents(
        spark,
        [
            (1, prose, "en"), (2, f"  {other}\n twice  spaced ", "en"), (5, prose, "en"), (5, third, "en"), (6, "123 !!", "en"),
            (6, f"{other} and more words in it", "en"), (None, "123 !!", None), (None, None, None), (None, prose, "en"),
            (None, f"{third} without an id", "en"),
        ],
    )
    texts = lambda frame: sorted((r.doc_id or 0, r.text or "") for r in frame.collect())
    lettered = corpus_pipeline.identify_languages(spark, docs, SF_DIR)
    assert lettered.columns == docs.columns
    found = texts(lettered)
    assert (6, "123 !!") not in found and (0, "123 !!") not in found and (0, "") not in found
    assert (6, f"{other} and more words in it") in found
    single = texts(corpus_pipeline.drop_exact_copies(spark, docs, SF_DIR))
    assert (5, third) in single and (5, prose) not in single and (0, prose) not in single
    assert (0, f"{third} without an id") in single
    spaced = documents(spark, [(1, third, "en"), (2, loose, "en"), (3, other, "en"), (None, third, "en")])
    assert texts(corpus_pipeline.drop_near_copies(spark, spaced, SF_DIR)) == [(0, third), (1, third), (3, other)]


def test_a_run_leaves_only_its_last_tables(spark, given, monkeypatch):
    import os

    from sparkgate.sources.staging import staging_root, staging_scope

    given("documents")
    folder = f"{staging_root(spark)}/sparkgate"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with staging_scope():
        rows = corpus_pipeline.run(spark, SF_DIR)
        assert rows.count() > 0
        made = set(os.listdir(folder)) - before
        assert {name.rpartition("-")[0] for name in made} == {"pipeline", "llm"}
        pipeline = next(name for name in made if name.startswith("pipeline"))
        assert os.listdir(f"{folder}/{pipeline}") == ["secret_scan"]
        # The pieces that the last stage packs.
        assert len([name for name in made if name.startswith("llm")]) == 1
    assert set(os.listdir(folder)) == before
