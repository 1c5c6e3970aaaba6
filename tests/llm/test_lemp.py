import math
import random

import numpy as np
import pytest

from sparkgate.llm import lemp

SCHEMA = "vec_id long, embedding array<float>, label int, cells string, part int, `a.b` int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, g, "x", 3, 1) for i, v, g in rows], SCHEMA)


def by_hand(rows, every=50):
    taken = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        cells = [math.floor(256 * float(np.float32(x))) for x in vector]
        if i not in taken or (label, cells) < taken[i]:
            taken[i] = (label, cells)
    out = []
    for a, (label, q) in taken.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(q, p)), i, g) for i, (g, p) in taken.items() if i != a]
        scores.sort()
        for s, i, _ in [x for x in scores if x[2] == label][:5]:
            fit = [x for x in scores if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, i, n, j, -s, -t) for n, (t, j, _) in enumerate(fit, 1)]
    return sorted(out)


def found(frame):
    return sorted(map(tuple, lemp.mined(frame).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def clustered(seed, n, width, ids=None):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        size = rng.choice([0.05, 0.3, 1.0, 4.0])
        vector = [size * (x + rng.gauss(0, 0.3)) for x in rng.choice(centres)]
        rows.append((i, [float(np.float32(x)) for x in vector], rng.randrange(10)))
    return rows


def test_given_rows(given):
    rows = [(r.vec_id, r.embedding, r.label) for r in given("embeddings").collect()]
    assert found(given("embeddings")) == by_hand(rows)


@pytest.mark.parametrize("cells", [1 << 19, 900])
def test_lengths_and_clusters_in_many_parts(spark, monkeypatch, cells):
    monkeypatch.setattr(lemp, "PART_CELLS", cells)
    rows = clustered(3, 900, 6)
    assert found(table(spark, rows)) == by_hand(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lemp, "PART_CELLS", 60)
    rng = random.Random(8)
    same = [0.5, -0.25, 0.125]
    rows = [(i, list(same), i % 3) for i in range(120)]
    rows += [(i, [rng.uniform(-1, 1) for _ in range(rng.randrange(0, 4))], 4) for i in range(120, 260)]
    rows += [(300, None, 1), (350, same, None), (None, same, 1), (301, [float("nan"), 0.0, 1.0], 1)]
    rows += [(302, [float("inf"), 0.0, 1.0], 1), (303, [None, 1.0, 1.0], 1), (400, [0.0, 0.0, 0.0], 2), (450, [], 2)]
    rows += [(50, list(same), 2), (51, [3.0, 1.0, 0.0], 1), (51, [3.0, 1.0, 0.0], 1), (-50, same, 0), (-7, same, 9)]
    assert found(table(spark, rows)) == by_hand(rows)


def test_no_rows_and_one_row(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(50, [1.0], 1)])) == []


def test_scores_beyond_doubles(spark):
    rows = [(i, [1e9 + i, 2e9 - i, 1.0], i % 2) for i in range(0, 60)]
    rows = [(i, [float(np.float32(x)) for x in v], g) for i, v, g in rows]
    limit = (1 << 63) - 1
    assert found(table(spark, rows)) == [(*r[:4], min(limit, r[4]), min(limit, r[5])) for r in by_hand(rows)]


@pytest.mark.parametrize("seed", range(4))
def test_ranges_spare_no_row(seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(8, 12)) * 100
    vectors = np.round(centre[rng.integers(0, 8, 700)] + rng.normal(size=(700, 12)) * 8).astype(np.int64)
    bucket = lemp.LengthBucket(np.arange(700), np.zeros(700, np.int64), vectors)
    pruned = 0
    for anchor in vectors[:40]:
        scores = vectors @ anchor
        for rank in (3, 40):
            least = np.sort(scores)[-rank]
            rows = bucket.candidates(anchor.astype(float), float(least))
            assert rows is None or set(np.flatnonzero(scores >= least)) <= set(rows)
            pruned += rows is not None and len(rows) < 350
    assert pruned > 10


def test_short_buckets_are_not_visited(spark, monkeypatch):
    monkeypatch.setattr(lemp, "PART_CELLS", 60)
    rows = [(i, [10.0, float(i % 7)], i % 2) for i in range(0, 200)] + [(i, [0.01, 0.01], i % 2) for i in range(200, 600)]
    asked = []
    real = lemp.Index.meeting
    monkeypatch.setattr(lemp.Index, "meeting", lambda *args: asked.append(args) or real(*args))
    assert found(table(spark, rows)) == by_hand(rows)
    index, anchors, search = asked[0]
    assert len(index.tops) > 1 and anchors.filter("vec_id < 200 AND least > 0").count() == 4
    reached = real(index, anchors.filter("vec_id < 200"), search)
    assert reached.filter("row_id >= 200").isEmpty()
