import hashlib
import random
import zlib

import numpy as np
import pytest

from llm_frames import documents
from sparkgate.llm import runs


def runs_by_hand(words, least=12):
    """All maximal stretches of every period, of those with the same words the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        start = None
        for at in range(n - q + 1):
            same = at < n - q and words[at] == words[at + q]
            if same and start is None:
                start = at
            if not same and start is not None:
                if at + q - start >= max(least, 2 * q):
                    found.setdefault((start, at + q - start), q)
                start = None
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda run: (run[0], run[2]))


def row_by_hand(doc_id, text):
    words = runs._WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(words)
    gone = {at for s, length, q in found for at in range(s + q, s + length)}
    best = sorted(found, key=lambda run: (-run[1], run[0], run[2]))[0] if found else (None, None, None)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        sha(" ".join(word for at, word in enumerate(words) if at not in gone)),
    )


def test_suffixes_in_order():
    rng = np.random.default_rng(2)
    for letters in (1, 2, 5, 50):
        symbols = rng.integers(0, letters, 120)
        order, place = runs.suffix_array(symbols)
        assert order.tolist() == sorted(range(120), key=lambda at: symbols[at:].tolist())
        assert place[order].tolist() == list(range(120))


def test_squares_that_branch():
    rng = random.Random(4)
    for _ in range(150):
        text = [rng.randrange(2) for _ in range(rng.randrange(2, 40))]
        n = len(text)
        expected = [
            (i, d) for i in range(n) for d in range(1, n) if i + 2 * d <= n and text[i : i + d] == text[i + d : i + 2 * d]
            and (i + 2 * d == n or text[i + d] != text[i + 2 * d])
        ]
        assert runs.branching_tandems(np.array(text)) == sorted(expected)


@pytest.mark.parametrize("seed", range(8))
def test_runs_against_all_periods(seed):
    rng = random.Random(seed)
    for _ in range(120):
        part = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(1, 25))]
        text = part * rng.randrange(1, 7)
        for _ in range(rng.randrange(4)):
            text.insert(rng.randrange(len(text) + 1), rng.randrange(4))
        for least in (1, 12):
            assert runs.runs(np.array(text), least) == runs_by_hand(text, least)


def test_long_runs_take_no_longer_than_their_words():
    n = 60_000
    assert runs.runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    rng = np.random.default_rng(1)
    part = rng.integers(0, 1000, 7_000)
    found = runs.runs(np.concatenate([part, part, part, part[:100], [5000]]))
    assert (0, 21_100, 7_000) in found


def test_windows_that_rule_runs_out():
    rng = random.Random(7)
    texts = [[rng.randrange(3) for _ in range(rng.randrange(0, 30))] for _ in range(300)]
    due = runs.may_repeat([np.array(text, np.int64) for text in texts])
    assert all(due[n] for n, text in enumerate(texts) if runs_by_hand(text))
    assert not due.all()


def test_rows(spark, odd, none):
    found = sorted(map(tuple, runs.digests(odd).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect() if len(r.text or "") < 10_000]
    by_hand = sorted((row_by_hand(*row) for row in rows), key=str)
    assert [r for r in found if r[0] not in (4, 5)] == by_hand
    assert runs.digests(none).count() == runs.periodic_runs(none).count() == 0
    many = documents(spark, [(n, " ".join(f"w{k}" for k in range(n % 37)), "en") for n in range(400)])
    assert sorted(map(tuple, runs.digests(many).collect())) == sorted(
        row_by_hand(r.doc_id, r.text) for r in many.collect()
    )


def test_real_output(spark):
    text = "x " + "a b c " * 5 + "a y " + "z\t" * 12 + "end"
    row = runs.periodic_runs(documents(spark, [(1, text, "en")])).first()
    assert [tuple(run) for run in row["runs"]] == [(1, 16, 3), (18, 12, 1)]
    assert row["collapsed"] == "x a b c y z end"


def test_given_rows(given):
    docs = given("documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    short = {i for i, text in rows if len(text or "") < 8_000}
    found = {r[0]: tuple(r) for r in runs.digests(docs).collect()}
    assert len(found) == len(rows)
    assert {i: found[i] for i in short} == {i: row_by_hand(i, text) for i, text in rows if i in short}
