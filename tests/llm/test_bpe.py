import hashlib
import random

import pytest

from sparkgate.llm import bpe
from sparkgate.llm.vocabulary import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path("word_bpe_49k.json")
TEXTS = [
    "", "   ", "a", "Hello's  World\n\tyou're I'll 12 345!!??", "aaaa aaaaaaa bananananana",
    "x<|endoftext|>y <|startoftext|> <|endoftext|><|endoftext|>", "é é ẛ̣ \xa0\x85\x1c b",
    "ΟΔΟΣ İ ﬁ Ⱥ ẞ 漢字 ا 🙂🙂", "</w> the</w>", "x" * 3000,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_ids_and_decoding_are_the_librarys(library):
    coder = bpe.WordBpe(PATH)
    rng = random.Random(4)
    letters = [32, 32, 97, 98, 39, 115, 116, 0x130, 0x3A3, 0x301, 0x41, 0xC9, 0x2028, 49, 33]
    texts = TEXTS + ["".join(chr(rng.choice(letters)) for _ in range(50)) for _ in range(500)]
    texts += [f"a{chr(c)}b {chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for text, chunks in zip(texts, coder.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert [int(n) for c in chunks for n in c[0].split()] == ids, repr(text)
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (
        len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def test_digests_of_frames(library, given, odd, none):
    for docs in (given("documents"), odd):
        rows = [(r.doc_id, expected(library, r.text)) for r in docs.select("doc_id", "text").collect()]
        found = [(r[0], tuple(r)[1:]) for r in bpe.digests(docs).collect()]
        assert sorted(found, key=str) == sorted(rows, key=str)
    assert bpe.digests(none).count() == 0


def test_ids_are_real_output(library, odd):
    row = bpe.encoded(odd.filter("doc_id = 10")).first()
    ids = library.encode(odd.filter("doc_id = 10").first().text, add_special_tokens=False).ids
    assert row.ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False)
