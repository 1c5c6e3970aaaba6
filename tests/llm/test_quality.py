from collections import Counter

import numpy as np
import pytest

from llm_frames import documents
from sparkgate.llm import quality


def by_hand(text):
    text = text or ""
    words = quality._WORD.findall(text)
    windows = list(zip(*[words[i:] for i in range(5)]))
    often = Counter(windows)
    covered = {at + step for at, w in enumerate(windows) if often[w] > 1 for step in range(5)}
    lines = [line for line in text.split("\n") if quality._WORD.search(line)]
    n = len(words)
    return (
        n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(covered), n < 10 or 100 * len(covered) > 20 * n,
    )


@pytest.mark.parametrize(
    "text",
    [None, "", "a", "a b c d e a b c d e", "x\nx\n\n \nx y z", "a a a a a a a", "<p>|#*$%& 1 \x1c2", "one two\n" * 40],
)
def test_counts_of_a_text(text):
    assert quality.text_statistics(text)[:6] == by_hand(text)


def test_counts_of_given_rows(given):
    docs = given("documents")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = {r[0]: tuple(r)[1:] for r in quality.statistics(docs).select("doc_id", *names).collect()}
    assert found == {r.doc_id: by_hand(r.text) for r in docs.select("doc_id", "text").collect()}


def test_verdicts_on_labelled_rows(given):
    docs, labels = given("documents"), given("labels")
    rows = quality.judged(docs, labels).filter("NOT base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_odd_rows_and_missing_labels(spark, odd, none):
    labels = spark.createDataFrame([(4, None), (None, 1), (99, 0)], "doc_id long, quality int")
    found = quality.judged(odd, labels)
    assert found.count() == odd.count()
    assert found.filter("kept").count() == found.filter("NOT base_failed").count()
    assert quality.judged(none, labels).count() == 0
    one = documents(spark, [(4, " ".join(map(str, range(30))), "en")])
    assert quality.judged(one, spark.createDataFrame([(4, 1)], "doc_id long, quality int")).filter("kept").count() == 1


def test_far_rows_have_short_paths():
    rng = np.random.default_rng(3)
    rows = np.vstack([rng.normal(size=(400, 2)), [[9, 9], [-8, 7]]])
    scores = quality.Forest.fit(rows).scores(rows)
    assert set(np.argsort(scores)[-2:]) == {400, 401}
    assert ((scores > 0) & (scores < 1)).all()


def test_equal_scores_and_one_kind_of_label(spark):
    text = " ".join(map(str, range(30)))
    rows = documents(spark, [(n, text, "en") for n in range(40)])
    for label in (0, 1):
        told = spark.createDataFrame([(n, label) for n in range(20)], "doc_id long, quality int")
        assert quality.judged(rows, told).filter("kept").count() == 40
    mixed = spark.createDataFrame([(n, n % 2) for n in range(20)], "doc_id long, quality int")
    assert quality.judged(rows, mixed).filter("kept").count() == 40


def test_threshold_over_bins():
    bins = quality.SCORE_BINS + 1
    good, bad = np.zeros(bins), np.zeros(bins)
    good[[100, 300]], bad[[299, 300, 500, 700]] = 500, 1
    assert quality.threshold(good, bad) == 499
    good[600] = 3
    assert quality.threshold(good, bad) == 499
    good[600] = 30
    assert quality.threshold(good, bad) == 699
    assert quality.threshold(good, np.zeros(bins)) == quality.threshold(np.zeros(bins), bad) == quality.SCORE_BINS


def test_pages_of_repeated_short_lines(spark, given):
    docs, labels = given("documents"), given("labels")
    own = [" ".join(f"{word}{n}" for word in ("one", "more", "line", "of", "words")) for n in range(40)]
    page = "\n".join(line for pair in zip(own, ["read"] * 40) for line in pair)
    count = quality.text_statistics(page)
    assert not count[5] and count[3] == 39
    made = documents(spark, [(-1, page, "en")]).select(*docs.columns)
    row = quality.judged(docs.union(made), labels).filter("doc_id = -1").first()
    assert not row["base_failed"] and not row["kept"]


def test_scores_against_paths_by_hand():
    """Scores of trees walked node by node, as the definition has it."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(300, 2))
    forest = quality.Forest.fit(rows, trees=20, tree_rows=64)

    def path(row, node):
        while forest.feature[node] >= 0:
            under = row[forest.feature[node]] < forest.split[node]
            node = forest.left[node] if under else forest.right[node]
        return forest.path[node]

    expected = [2 ** (-np.mean([path(row, root) for root in forest.roots]) / forest.norm) for row in rows]
    assert np.allclose(forest.scores(rows), expected)
