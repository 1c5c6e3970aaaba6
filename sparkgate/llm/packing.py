"""Packing token pieces into sequences: bounded-space online best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.tables import stage, tidied
from sparkgate.llm.vocabulary import byte_encoder, tokenizer_path

CAPACITY = 1024
END_ID = 2
# Bins a task keeps open. When one more opens, the fullest closes.
OPEN_BINS = 1_024
# Pieces are sorted before they arrive: larger ones first within windows of about so many. On the 0.1
# tables, whose pieces would fill 9,871 sequences, that takes 9,880; unsorted, the same bins take
# 9,977. Windows so large that their large pieces close the bins small ones would have filled take
# more again.
WINDOW_PIECES = 4_096
# Pieces one task packs.
TASK_PIECES = 100_000
# Sequence ids are the task's number times this, plus a counter.
TASK_STRIDE = 1 << 40

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
_PLACED = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])


class BestFit:
    """Open bins by free space, whose non-empty classes are bits of one integer."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self._capacity, self._most = capacity, open_bins
        self._bits, self._open, self._made = 0, 0, 0
        self.closed = 0
        self._bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        number = self._bins[free].pop()
        if not self._bins[free]:
            self._bits &= ~(1 << free)
        self._open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of a piece: the open bin with the least free space that suffices."""
        fitting = self._bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self._capacity, self._made
            self._made += 1
        left = free - size
        if left:
            self._bins[left].append(number)
            self._bits |= 1 << left
            self._open += 1
            if self._open > self._most:
                self._take((self._bits & -self._bits).bit_length() - 1)
                self.closed += 1
        return number, self._capacity - free


def cut(n_tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, if longer than capacity."""
    first = n_tokens % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n_tokens, capacity)]


def pieces(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32.

    A document's ids end with end_id; a null or empty text has that id alone.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = np.append(encoder(text.as_py() or ""), end_id).astype("<u4")
                for n, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((doc_id, n, start, length, crc))
            columns = zip(*out) if out else [[]] * len(_PIECES)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

    return documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    ).mapInArrow(tidied(encode), from_arrow_schema(_PIECES))


def pack(
    parts: DataFrame,
    *,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    task_pieces: int = TASK_PIECES,
) -> DataFrame:
    """parts with sequence_id and offset, no sequence longer than capacity and none with a gap.

    Pieces are dealt to tasks by content and packed there one by one, in an order taken from
    content too, so that a task that runs again packs alike. A task holds open_bins bins at most.
    Sequences do not span tasks: each task may leave one or two part-filled ones more.
    """
    n_parts = parts.count()
    tasks = max(1, -(-n_parts // task_pieces))
    windows = max(1, round(n_parts / tasks / WINDOW_PIECES))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() * TASK_STRIDE
        for batch in batches:
            spots = np.array([fit.place(size) for size in batch["length"].to_pylist()], np.int64).reshape(-1, 2)
            columns = [batch[name] for name in _PIECES.names]
            yield pa.record_batch([*columns, pa.array(spots[:, 0] + base), pa.array(spots[:, 1])], schema=_PLACED)

    dealt = parts.withColumn(
        "window", F.pmod(F.xxhash64("piece", "doc_id"), F.lit(windows))
    ).repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32"))
    ordered = dealt.sortWithinPartitions("window", F.desc("length"), "doc_id", "piece", "ids_crc32")
    return ordered.mapInArrow(tidied(place), from_arrow_schema(_PLACED))


def packed_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every piece of every document in its place, see pieces() and pack().

    Null and empty texts hold one id. Null ids stay null. Repeated rows are packed as often as
    they occur. Very long texts are cut, nothing is dropped. Columns beside id and text are not
    read. No rows, no pieces.
    """
    split = pieces(documents, id_col, text_col, **options)
    return pack(stage(split, "pieces"), capacity=options.get("capacity", CAPACITY))
