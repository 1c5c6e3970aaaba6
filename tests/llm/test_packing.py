import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sparkgate.llm import packing
from sparkgate.llm.vocabulary import byte_encoder, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def sound(rows, capacity=1024):
    """Sequences without gaps or overflow; returns how many there are."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_ids_are_the_librarys(library):
    texts = ["", " ", "a  b\n\n c", "x<|endoftext|>y", "ñ 漢字 🙂 \xa0 x", " " * 2000, "it's I'LL 12"]
    texts += [f"a{chr(c)}1 {chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    encode = byte_encoder(PATH)
    for text in texts:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_piece_of_every_document(library, given, odd):
    for docs in (given("documents"), odd):
        rows = packing.packed_documents(docs).collect()
        expected = []
        for r in docs.select("doc_id", "text").collect():
            ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
            cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)]
            for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                expected.append((r.doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
        assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(expected, key=str)
        total = sum(r.length for r in rows)
        assert sound(rows) <= 1.1 * -(-total // 1024) + 1


def test_several_tasks(given):
    parts = packing.pieces(given("documents"))
    rows = packing.pack(parts, task_pieces=50).collect()
    assert len(rows) == parts.count()
    sound(rows)


def test_no_rows(none):
    assert packing.packed_documents(none).count() == 0


def test_best_fit_against_trying_all_bins():
    rng = random.Random(1)
    fit, free = packing.BestFit(100, 1 << 30), []
    for _ in range(2000):
        size = rng.randint(1, 100)
        options = [(left, n) for n, left in enumerate(free) if left >= size]
        least = min(options)[0] if options else 100
        number, offset = fit.place(size)
        if number == len(free):
            free.append(100)
            assert not options
        assert free[number] == least and offset == 100 - least
        free[number] -= size


def test_open_bins_are_bounded_and_the_fullest_closes():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n)[0] for n in (6, 7, 8)] == [0, 1, 2]
    # The bin with 8 closed, as the fullest of three; 2 goes to the one with 3 left, not to it.
    assert fit.place(2) == (1, 7)


def test_cut():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(1024) == [(0, 1024)]
    assert packing.cut(2049) == [(0, 1), (1, 1024), (1025, 1024)]


def test_the_bound_binds_and_costs_little(spark):
    rng = random.Random(3)
    sizes = [min(1024, int(rng.lognormvariate(6, 1)) + 1) for _ in range(15_000)]
    fit = packing.BestFit(packing.CAPACITY, packing.OPEN_BINS)
    for at in range(0, len(sizes), packing.WINDOW_PIECES):
        for size in sorted(sizes[at : at + packing.WINDOW_PIECES], reverse=True):
            fit.place(size)
    assert fit.closed > 100
    rows = [(n, 0, 0, size, n) for n, size in enumerate(sizes)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long"))
    assert sound(packed.collect()) <= 1.02 * -(-sum(sizes) // 1024)
