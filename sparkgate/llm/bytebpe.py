"""Byte-level BPE under a file of ranks: text to ids and back, merging over a segment tree."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.vocabulary import SPLIT, tokenizer_path

# Chunks a worker remembers, and the longest of them; longer ones are encoded each time.
KNOWN_CHUNKS, KNOWN_LENGTH = 400_000, 128
# Pieces of up to so many bytes are merged together, longer ones one by one.
TOGETHER_BYTES = 64
# Documents are encoded in groups of about so many characters.
GROUP_CHARS = 1_000_000

# The pattern joins one space at most to what follows, and no piece goes on past other white space.
# So text falls apart into chunks whose pieces depend on the chunk alone. These are the characters
# with the property White_Space, which is what the pattern's \s stands for.
_BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_PIECE = regex.compile(SPLIT)
_NO_RANK = 1 << 62


class RankTree:
    """The ranks of a piece's adjacent pairs, by the byte position at which a pair starts.

    A segment tree: each node holds the least rank below it, and of equal ranks the leftmost. So
    the root names the next pair to merge, and a change of one pair's rank touches one path.
    """

    def __init__(self, ranks: Sequence[int | None]) -> None:
        self._width = len(ranks)
        self._leaves = 1 << max(0, len(ranks) - 1).bit_length()
        nodes = [_NO_RANK] * (2 * self._leaves)
        for at, rank in enumerate(ranks):
            if rank is not None:
                nodes[self._leaves + at] = rank * self._width + at
        for node in range(self._leaves - 1, 0, -1):
            left, right = nodes[2 * node], nodes[2 * node + 1]
            nodes[node] = left if left < right else right
        self._nodes = nodes

    def first(self) -> int | None:
        """The position of the pair to merge next; none if no pair has a rank."""
        best = self._nodes[1]
        return None if best == _NO_RANK else best % self._width

    def put(self, at: int, rank: int | None) -> None:
        """Set the rank of the pair at this position, up to where nothing changes any more."""
        nodes, node = self._nodes, self._leaves + at
        nodes[node] = _NO_RANK if rank is None else rank * self._width + at
        while node > 1:
            node >>= 1
            left, right = nodes[2 * node], nodes[2 * node + 1]
            least = left if left < right else right
            if nodes[node] == least:
                return
            nodes[node] = least


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: the leftmost pair of least rank is merged until no pair has a rank.

    A symbol is known by the byte it starts at; live symbols are a doubly linked list. A merge
    drops the pair that starts at its right half and ranks its own pair and the one before anew.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    tree = RankTree([ranks.get(piece[at : at + 2]) for at in range(n - 1)])
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while (at := tree.first()) is not None:
        right = after[at]
        end = after[at] = after[right]
        if right < n - 1:
            tree.put(right, None)
        if end < n:
            before[end] = at
            tree.put(at, ranks.get(piece[at : after[end]]))
        else:
            tree.put(at, None)
        left = before[at]
        if left >= 0:
            tree.put(left, ranks.get(piece[left:end]))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class PairRanks:
    """The rank of every pair of tokens whose bytes make a token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self._width = max(ranks.values()) + 1
        pairs = {
            ranks[token[:cut]] * self._width + ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self._keys = np.array(sorted(pairs) or [-1], np.int64)
        self._ranks = np.array([pairs.get(key, _NO_RANK) for key in self._keys.tolist()], np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; _NO_RANK where there is none, or either side is below 0."""
        pair = np.where((left < 0) | (right < 0), -2, left * self._width + right)
        at = np.minimum(np.searchsorted(self._keys, pair), len(self._keys) - 1)
        return np.where(self._keys[at] == pair, self._ranks[at], _NO_RANK)


def merged_together(pieces: Sequence[bytes], byte_ids: np.ndarray, pairs: PairRanks) -> list[list[int]]:
    """merged() of many pieces that are no tokens themselves: a tree for each, one merge of each a round.

    Trees have the width of the longest piece's, so pieces should be about equally long.
    """
    sizes = np.array([len(piece) for piece in pieces], np.int64)
    width = 1 << int(sizes.max() - 1).bit_length()
    every = np.arange(len(pieces))
    places = np.arange(width + 1)
    symbols = np.full((len(pieces), width + 1), -1, np.int64)
    symbols[places < sizes[:, None]] = byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    rank = pairs.of(symbols[:, :-1], symbols[:, 1:])
    nodes = np.full((len(pieces), 2 * width), _NO_RANK, np.int64)
    nodes[:, width:] = np.where(rank < _NO_RANK, rank * width + places[:-1], _NO_RANK)
    level = width
    while level > 1:
        level //= 2
        nodes[:, level : 2 * level] = np.minimum(nodes[:, 2 * level : 4 * level : 2], nodes[:, 2 * level + 1 : 4 * level : 2])
    after = np.tile(places + 1, (len(pieces), 1))
    before = np.tile(places - 1, (len(pieces), 1))
    live = every
    while True:
        first = nodes[live, 1]
        due = first < _NO_RANK
        live, first = live[due], first[due]
        if not len(live):
            break
        at, token = first % width, first // width
        right = after[live, at]
        end = after[live, right]
        left = before[live, at]
        symbols[live, at], symbols[live, right] = token, -1
        after[live, at], before[live, end] = end, at
        beside = pairs.of(token, symbols[live, end])
        ahead = pairs.of(np.where(left >= 0, symbols[live, left], -1), token)
        # The pair at the right half is gone; its own pair and the one before rank anew.
        spots = np.stack([right, at, np.where(left >= 0, left, right)])
        ranks = np.stack([np.full(len(live), _NO_RANK), beside, ahead])
        node = width + spots
        nodes[live, node] = np.where(ranks < _NO_RANK, ranks * width + spots, _NO_RANK)
        for _ in range(width.bit_length() - 1):
            node = node >> 1
            nodes[live, node] = np.minimum(nodes[live, 2 * node], nodes[live, 2 * node + 1])
    alive = symbols >= 0
    ids, ends = symbols[alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()
    return [ids[start:end] for start, end in zip([0, *ends], ends)]


class ByteBpe:
    """Encoder and decoder under a file of ranks: a base64 token and its rank, which is its id, per line."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self._decimals = {rank: str(rank) for rank in self.tokens}
        self._byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self._pairs = PairRanks(self.ranks)
        self._known: dict[str, tuple[str, int, bytes]] = {}

    def _piece_ids(self, pieces: Iterable[bytes]) -> dict[bytes, list[int]]:
        found: dict[bytes, list[int]] = {}
        by_width: dict[int, list[bytes]] = {}
        for piece in pieces:
            if piece in self.ranks or len(piece) > TOGETHER_BYTES:
                found[piece] = merged(piece, self.ranks)
            else:
                by_width.setdefault((len(piece) - 1).bit_length(), []).append(piece)
        for members in by_width.values():
            found.update(zip(members, merged_together(members, self._byte_ids, self._pairs)))
        return found

    def _learn(self, chunks: Sequence[str]) -> dict[str, tuple[str, int, bytes]]:
        """Chunks with their ids joined by commas, the ids' number and the bytes they stand for."""
        split = [[piece.encode() for piece in _PIECE.findall(chunk)] for chunk in chunks]
        decimals = self._decimals
        coded = {
            piece: (",".join([decimals[n] for n in ids]), len(ids), self.decode(ids))
            for piece, ids in self._piece_ids(dict.fromkeys(piece for part in split for piece in part)).items()
        }
        found = {}
        for chunk, part in zip(chunks, split):
            if len(part) == 1:
                found[chunk] = coded[part[0]]
            else:
                texts, counts, decoded = zip(*[coded[piece] for piece in part])
                found[chunk] = (",".join(texts), sum(counts), b"".join(decoded))
        return found

    def encode(self, texts: Sequence[str]) -> list[list[tuple[str, int, bytes]]]:
        """Of each text, its chunks' (ids joined by commas, number of ids, bytes decoded from them)."""
        split = [_CHUNK.findall(text) for text in texts]
        if len(self._known) > KNOWN_CHUNKS:
            self._known = {}
        known = self._known
        new = self._learn(list(dict.fromkeys(chunk for chunks in split for chunk in chunks if chunk not in known)))
        known.update(new)
        out = [[known[chunk] for chunk in chunks] for chunks in split]
        for chunk in new:
            if len(chunk) > KNOWN_LENGTH:
                del known[chunk]
        return out

    def ids(self, text: str) -> list[int]:
        """The ids of one text."""
        return [int(n) for ids, _, _ in self.encode([text])[0] for n in ids.split(",")]

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes that ids stand for."""
        return b"".join([self.tokens[n] for n in ids])


@cache
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


_DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)
_CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


def _coded(
    documents: DataFrame, id_col: str, text_col: str, tokenizer: str | None, schema: pa.Schema,
    row: Callable[[list[tuple[str, int, bytes]]], tuple],
) -> DataFrame:
    path = tokenizer or tokenizer_path("byte_bpe_multi_50k.tiktoken")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path)

        def coded(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
            rows = [(doc_id, *row(chunks)) for doc_id, chunks in zip(ids, coder.encode(texts))]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, cell in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids.append(doc_id)
                texts.append(cell.as_py() or "")
                size += len(texts[-1])
                if size >= GROUP_CHARS:
                    yield coded(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield coded(ids, texts)

    return documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).mapInArrow(encode, from_arrow_schema(schema))


def encoded(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) and decoded (the bytes that the ids stand for) of every text.

    Nothing is shuffled. tokenizer names a file of ranks. A null text counts as empty and has no
    ids; whole texts are encoded, a piece of any length in time n log n; ids may be null or repeat,
    each row is encoded by itself; other columns are not read. No rows, no rows.
    """
    return _coded(
        documents, id_col, text_col, tokenizer, _CODED,
        lambda chunks: ([int(n) for c in chunks for n in c[0].split(",")], b"".join([c[2] for c in chunks])),
    )


def digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None) -> DataFrame:
    """encoded(), with the number of ids and SHA-256 of the ids joined by commas and of the bytes."""

    def row(chunks: list[tuple[str, int, bytes]]) -> tuple[int, str, str]:
        return (
            sum([c[1] for c in chunks]),
            hashlib.sha256(",".join([c[0] for c in chunks]).encode()).hexdigest(),
            hashlib.sha256(b"".join([c[2] for c in chunks])).hexdigest(),
        )

    return _coded(documents, id_col, text_col, tokenizer, _DIGESTS, row)
