"""Word BPE: text to ids and back, by batched merge rounds over one flat array of symbols."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.vocabulary import byte_letters, tokenizer_path

# Chunks a worker remembers; beyond that it starts anew.
KNOWN_CHUNKS = 200_000
# Documents are encoded in groups of about so many characters.
GROUP_CHARS = 4_000_000

# Letters for which Python's lower case and white space are those of the tokenizer's normaliser,
# and which no normal form changes. Other texts go through the normaliser itself.
_PLAIN = re.compile("[\t-\r -~¡-įı-ɏ]*")
_BLANKS = re.compile("[\t-\r ]+")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_NO_RANK = np.iinfo(np.int64).max


def merge_rounds(
    symbols: np.ndarray, words: np.ndarray, keys: np.ndarray, ranks: np.ndarray, results: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """BPE merges of many words at once: symbols and the word each belongs to, merged to the end.

    keys holds left * width + right of every known pair, sorted; ranks and results belong to them.
    Each round finds every word's lowest-rank pair and merges all its occurrences, left to right.
    A pair made by a merge has a higher rank than that merge, so this is the order of one at a time.
    """
    out_symbols, out_words = [], []
    while len(symbols):
        pair = symbols[:-1] * width + symbols[1:]
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        known = (keys[at] == pair) & (words[:-1] == words[1:])
        rank = np.append(np.where(known, ranks[at], _NO_RANK), _NO_RANK)
        starts = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        best = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.append(starts, len(symbols)))
        best = np.repeat(best, lengths)
        done = best == _NO_RANK
        if done.any():
            out_symbols.append(symbols[done])
            out_words.append(words[done])
        hits = np.flatnonzero((rank == best) & ~done)
        if not len(hits):
            break
        # Of overlapping occurrences, as in a run of one symbol, every other one merges.
        fresh = np.append(True, np.diff(hits) != 1)
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
        hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
        symbols = symbols.copy()
        symbols[hits] = results[at[hits]]
        left = ~done
        left[hits + 1] = False
        symbols, words = symbols[left], words[left]
    if not out_symbols:
        return symbols, words
    symbols, words = np.concatenate(out_symbols), np.concatenate(out_words)
    order = np.argsort(words, kind="stable")
    return symbols[order], words[order]


class WordBpe:
    """Encoder and decoder under a word BPE file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._tokenizer = Tokenizer.from_file(path)
        model = spec["model"]
        vocab, self._suffix = model["vocab"], model["end_of_word_suffix"]
        self._added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {n: token for token, n in [*vocab.items(), *self._added.items()]}
        self._special = re.compile("(" + "|".join(map(re.escape, self._added)) + ")")
        self._width = max(self.tokens) + 1
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        keys = np.array([vocab[a] * self._width + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], order.astype(np.int64)
        self._results = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        letters = byte_letters()
        self._byte_of = {letter: b for b, letter in letters.items()}
        self._inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self._last = np.array([vocab[letters[b] + self._suffix] for b in range(256)], np.int64)
        self._known: dict[str, tuple[str, int, str]] = {}

    def _normal(self, text: str) -> str:
        if _PLAIN.fullmatch(text):
            return _BLANKS.sub(" ", text).lower()
        return self._tokenizer.normalizer.normalize_str(text)

    def _words(self, chunk: str) -> list[bytes]:
        if _PLAIN.fullmatch(chunk):
            return [word.encode() for word in _WORD.findall(chunk)]
        split = self._tokenizer.pre_tokenizer.pre_tokenize_str(chunk)
        return [bytes(self._byte_of[letter] for letter in word) for word, _ in split]

    def _learn(self, chunks: Sequence[str]) -> None:
        """Encode chunks, pieces of text without spaces, all in the same merge rounds."""
        split = [self._words(chunk) for chunk in chunks]
        words = [word for part in split for word in part]
        sizes = np.array([len(word) for word in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self._inner[raw]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self._last[raw[ends]]
        owner = np.repeat(np.arange(len(chunks)), [sum(map(len, part)) for part in split])
        word_no = np.repeat(np.arange(len(words)), sizes)
        chunk_of_word = np.zeros(len(words), np.int64)
        chunk_of_word[word_no] = owner
        ids, of_word = merge_rounds(symbols, word_no, self._keys, self._ranks, self._results, self._width)
        counts = np.bincount(chunk_of_word[of_word], minlength=len(chunks))
        ids, at = ids.tolist(), 0
        for chunk, n in zip(chunks, counts.tolist()):
            own = ids[at : at + n]
            at += n
            self._known[chunk] = (" ".join(map(str, own)), n, " ".join(self.tokens[i] for i in own))

    def encode(self, texts: Sequence[str]) -> list[list[tuple[str, int, str]]]:
        """Of each text, its chunks' (ids joined by spaces, number of ids, text decoded)."""
        split = []
        for text in texts:
            chunks = []
            for n, part in enumerate(self._special.split(text)):
                chunks += [part] if n % 2 else self._normal(part).split(" ")
            split.append([chunk for chunk in chunks if chunk])
        if len(self._known) > KNOWN_CHUNKS:
            self._known = {}
        for token, n in self._added.items():
            self._known[token] = (str(n), 1, token)
        new = dict.fromkeys(chunk for chunks in split for chunk in chunks if chunk not in self._known)
        if new:
            self._learn(list(new))
        return [[self._known[chunk] for chunk in chunks] for chunks in split]

    def ids(self, text: str) -> list[int]:
        """The ids of one text."""
        return [int(n) for part in self.encode([text])[0] for n in part[0].split()]

    def decode(self, ids: Sequence[int]) -> str:
        """Tokens joined by spaces, special ones too: the file names no decoder."""
        return " ".join(self.tokens[n] for n in ids)


@cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


_DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)
_CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _groups(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for n, text in enumerate(texts):
        size += len(text)
        if size >= GROUP_CHARS:
            yield slice(start, n + 1)
            start, size = n + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _coded(documents: DataFrame, id_col: str, text_col: str, tokenizer: str | None, schema: pa.Schema, row) -> DataFrame:
    path = tokenizer or tokenizer_path("word_bpe_49k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_bpe(path)
        for batch in batches:
            texts = [text or "" for text in batch["text"].to_pylist()]
            for part in _groups(texts):
                rows = [row(chunks) for chunks in coder.encode(texts[part])]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])]
                ids = batch["doc_id"].slice(part.start, len(rows))
                yield pa.record_batch([ids, *columns], schema=schema)

    return documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    ).mapInArrow(encode, from_arrow_schema(schema))


def encoded(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) and decoded (the ids' tokens joined by spaces) of every text.

    Nothing is shuffled. A null text counts as empty and has no ids; ids may be null or repeat, each
    row is encoded by itself; whole texts are encoded; other columns are not read.
    """
    return _coded(
        documents, id_col, text_col, tokenizer, _CODED,
        lambda chunks: ([int(n) for c in chunks for n in c[0].split()], " ".join([c[2] for c in chunks if c[1]])),
    )


def digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None) -> DataFrame:
    """encoded(), with counts and SHA-256 in place of the ids and texts."""

    def row(chunks: list[tuple[str, int, str]]) -> tuple[int, str, str]:
        ids, decoded = " ".join([c[0] for c in chunks if c[1]]), " ".join([c[2] for c in chunks if c[1]])
        return (
            sum([c[1] for c in chunks]),
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )

    return _coded(documents, id_col, text_col, tokenizer, _DIGESTS, row)
