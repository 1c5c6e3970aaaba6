import random
from itertools import combinations

import numpy as np
import pytest

from llm_frames import documents
from sparkgate.llm import darts, near
from sparkgate.llm.components import components


def by_hand(rows, least=0.8):
    """Classes by comparing all pairs."""
    def sets(text):
        words = [w for w in near._WORD.findall(text or "")]
        width = min(5, len(words))
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if width else set()

    named = [(i, sets(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in named}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(named, 2):
        if x and y and len(x & y) >= least * len(x | y) - 1e-12:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: root(i) for i in parent}


def classes(frame, **options):
    return {r.doc_id: r.class_id for r in near.near_duplicates(frame, **options).collect() if r.doc_id is not None}


def test_given_rows(given):
    docs = given("documents")
    assert classes(docs) == by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_odd_rows(odd):
    found = near.near_duplicates(odd)
    assert found.count() == odd.count()
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert classes(odd) == by_hand(rows)
    assert {(r.class_id, r.kept) for r in found.filter("doc_id IS NULL").collect()} == {(None, True)}


def test_no_rows(none):
    assert near.near_duplicates(none).count() == 0


def test_one_large_group_and_texts_that_share_a_passage(spark):
    rng = random.Random(5)
    words = [f"w{n}" for n in range(5000)]
    base = [rng.choice(words) for _ in range(300)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randrange(0, 9)):
            text[rng.randrange(300)] = rng.choice(words)
        rows.append((i, " ".join(text), "en"))
    passage = base[:60]
    for i in range(150, 260):
        rows.append((i, " ".join([rng.choice(words) for _ in range(90)] + passage), "en"))
    assert classes(documents(spark, rows)) == by_hand([r[:2] for r in rows])


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)] + [(5, 7), (9, 9)]
    found = components(spark.createDataFrame(path + star, "a long, b long"))
    expected = {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(7, 60)]}
    assert {r.node: r.class_id for r in found.collect()} == expected


@pytest.mark.parametrize("seed", range(3))
def test_signatures_estimate_weighted_similarity(seed):
    rng = np.random.default_rng(seed)
    a = {n: float(rng.choice([0.3, 1, 2.5, 7, 20])) for n in range(60)}
    b = {n: (a.get(n, 1.0) if rng.random() < 0.7 else float(rng.choice([0.3, 1, 7]))) for n in range(10, 70)}
    keys = a.keys() | b.keys()
    true = sum(min(a.get(n, 0), b.get(n, 0)) for n in keys) / sum(max(a.get(n, 0), b.get(n, 0)) for n in keys)
    elements = darts.mix(np.array([*a, *b], np.uint64))
    owners = np.repeat([0, 1], [len(a), len(b)])
    signature = darts.signatures(elements, owners, np.array([*a.values(), *b.values()]), 2, 4000)
    assert abs((signature[0] == signature[1]).mean() - true) < 0.04


def test_counts_as_weights():
    assert near.similarity("a b c d e a b c d e", "a b c d e", by_count=True) == pytest.approx(1 / 6)
    assert near.similarity("a b c d e", "a b c d e") == 1.0
    assert near.similarity("", "") == 0.0


def variants(rng, n, width, most, vocabulary):
    base = [rng.choice(vocabulary) for _ in range(width)]
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(most)):
            text[rng.randrange(width)] = rng.choice(vocabulary)
        yield " ".join(text)


@pytest.mark.parametrize(("n", "width", "most", "words"), [(900, 300, 38, 4000), (500, 80, 9, 12), (400, 60, 30, 300)])
def test_many_variants_of_one_text(spark, n, width, most, words):
    """Far apart from each other in the mean, so that star rounds leave most of them apart."""
    rng = random.Random(n)
    rows = list(enumerate(variants(rng, n, width, most, [f"w{k}" for k in range(words)])))
    found = classes(documents(spark, [(i, text, "en") for i, text in rows]))
    expected = by_hand(rows)
    assert len(set(expected.values())) > 20
    assert found == expected


def test_ids_of_several_texts_each_with_a_copy(spark):
    rng = random.Random(9)
    words = [f"w{n}" for n in range(3000)]
    rows = []
    for i in range(40):
        for part in range(2):
            text = [rng.choice(words) for _ in range(100)]
            rows.append((i, " ".join(text)))
            text[rng.randrange(100)] = "other"
            rows.append((1000 + 2 * i + part, " ".join(text)))
        rows.append((i, rows[-2][1]))
        rows.append((i, None))
    found = near.near_duplicates(documents(spark, [(*row, "en") for row in rows]))
    assert found.count() == len(rows)
    assert {(r.doc_id, r.class_id) for r in found.collect()} == set(by_hand(rows).items())


def counted_by_hand(rows, least=0.8):
    from collections import Counter

    def bag(text):
        words = text.split()
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(i, bag(text)) for i, text in rows]
    for (a, x), (b, y) in combinations(bags, 2):
        if (x & y).total() >= least * (x | y).total() - 1e-12:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: root(i) for i in parent}


def test_counts_as_weights_in_a_whole_run(spark):
    rng = random.Random(3)
    words = [f"w{n}" for n in range(500)]
    rows = []
    for i in range(120):
        line = [rng.choice(words) for _ in range(12)]
        for copy in range(3):
            rows.append((3 * i + copy, " ".join([rng.choice(words) for _ in range(4)] + line * rng.randrange(2, 9))))
    frame = documents(spark, [(i, text, "en") for i, text in rows])
    expected = counted_by_hand(rows)
    assert classes(frame, by_count=True) == expected
    assert 120 < len(set(expected.values())) < 360
    assert classes(frame) == by_hand(rows) != expected
