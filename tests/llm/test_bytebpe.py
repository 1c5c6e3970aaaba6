import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as some

from sparkgate.llm import bytebpe
from sparkgate.llm.vocabulary import SPLIT, tokenizer_path

PATH = tokenizer_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def by_library(library, text):
    ids = library.encode_ordinary(text or "")
    return (
        len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


@cases(some.text(some.characters(exclude_categories=["Cs", "Cn"]), max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    coder = bytebpe.byte_bpe(PATH)
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    ids = coder.ids(text)
    assert coder.decode(ids) == text.encode()
    assert all(ranks[coder.tokens[n]] == n for n in ids)


@pytest.mark.parametrize("seed", range(5))
def test_mixed_letters_blanks_and_marks(library, seed):
    rng = random.Random(seed)
    pool = "aaabbe  \n\t\r\x85\xa0　 'sdtrvelm119٣é漢字ß🙂🙂­İ\x1c​.,;--__"
    coder = bytebpe.byte_bpe(PATH)
    for _ in range(400):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(40)))
        assert coder.ids(text) == library.encode_ordinary(text)


def test_merges_that_a_whole_piece_skips():
    ranks = {bytes([b]): b for b in b"abcd"} | {b"ab": 200, b"bc": 150, b"abcd": 300}
    assert bytebpe.merged(b"abcd", ranks) == [300]
    assert bytebpe.merged(b"abcda", ranks) == [ord("a"), 150, ord("d"), ord("a")]


def by_scanning(piece, ranks):
    """Merges found by looking through all pairs, one merge at a time."""
    parts = [piece[n : n + 1] for n in range(len(piece))]
    while True:
        found = [(ranks[a + b], n) for n, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[part] for part in parts]
        _, n = min(found)
        parts[n : n + 2] = [parts[n] + parts[n + 1]]


@pytest.mark.parametrize("seed", range(20))
def test_tree_against_scanning(seed):
    rng = random.Random(seed)
    ranks = {b"a": 0, b"b": 1, b"c": 2}
    while len(ranks) < 40:
        token = rng.choice(list(ranks)) + rng.choice(list(ranks))
        ranks.setdefault(token, len(ranks))
    pieces = []
    for _ in range(60):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 50)))
        expected = [ranks[piece]] if piece in ranks else by_scanning(piece, ranks)
        assert bytebpe.merged(piece, ranks) == expected
        pieces.append(piece)
    loose = [piece for piece in pieces if piece not in ranks]
    ids = np.zeros(256, np.int64)
    ids[list(b"abc")] = 0, 1, 2
    found = bytebpe.merged_together(loose, ids, bytebpe.PairRanks(ranks))
    assert found == [by_scanning(piece, ranks) for piece in loose]


def test_pieces_of_any_length(library):
    coder = bytebpe.byte_bpe(PATH)
    rng = random.Random(1)
    for text in ["x" * 3001, " " * 5000 + "a", "\n" * 700, "".join(rng.choice("abcde") for _ in range(20_000))]:
        assert coder.ids(text) == library.encode_ordinary(text)


def test_rows(spark, odd, none, library):
    found = sorted(map(tuple, bytebpe.digests(odd).collect()), key=str)
    assert found == sorted(((r.doc_id, *by_library(library, r.text)) for r in odd.collect()), key=str)
    assert bytebpe.digests(none).count() == bytebpe.encoded(none).count() == 0
    for r in bytebpe.encoded(odd).join(odd.select("doc_id", "text"), "doc_id").collect():
        assert bytes(r.decoded) == (r.text or "").encode()


def test_given_rows(given, library):
    docs = given("documents")
    found = {r[0]: tuple(r)[1:] for r in bytebpe.digests(docs).collect()}
    assert found == {r.doc_id: by_library(library, r.text) for r in docs.select("doc_id", "text").collect()}
