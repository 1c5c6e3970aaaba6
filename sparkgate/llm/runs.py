"""Periodic runs of words: branching tandem repeats found in an enhanced suffix array."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.darts import mix

# A run has this many words at least, and twice its period.
LEAST_WORDS = 12
# Any run holds two equal windows of so many words, one period apart.
WINDOW = 6
# Texts are analysed in groups of about so many characters.
GROUP_CHARS = 1_000_000
# Suffixes of a child this many or more are looked up by numpy at once.
WIDE_CHILD = 64

_WORD = re.compile("[^ \t-\r]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def numbered(words: list[str]) -> np.ndarray:
    """Words as numbers, equal ones alike."""
    numbers: dict[str, int] = {}
    return np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)


def may_repeat(sequences: list[np.ndarray]) -> np.ndarray:
    """Whether two windows of WINDOW symbols of a sequence may be equal; surely not where it says no."""
    sizes = np.array([len(s) for s in sequences], np.int64)
    out = np.zeros(len(sequences), bool)
    if sizes.sum() < WINDOW:
        return out
    symbols, owner = np.concatenate(sequences).astype(np.uint64), np.repeat(np.arange(len(sizes)), sizes)
    n = len(symbols) - WINDOW + 1
    code = mix(owner[:n].astype(np.uint64) + np.uint64(1))
    for step in range(WINDOW):
        code = mix(code * _ODD + symbols[step : step + n])
    inside = owner[:n] == owner[WINDOW - 1 :]
    code, owner = code[inside], owner[:n][inside]
    order = np.argsort(code)
    code = code[order]
    out[owner[order[1:][code[1:] == code[:-1]]]] = True
    return out


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and each one's place. Symbols are 0 or more.

    Prefix doubling over the suffixes whose place is still open: ranks are places of groups, and
    each round sorts a group by the ranks of what follows the part already compared.
    """
    n = len(symbols)
    place = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    counts = np.bincount(place)
    place = (np.cumsum(counts) - counts)[place]
    open_ = np.argsort(place, kind="stable")
    length = 1
    while len(open_):
        first = place[open_]
        then = np.full(len(open_), -1, np.int64)
        within = open_ + length < n
        then[within] = place[open_[within] + length]
        order = np.lexsort((then, first))
        open_, first, then = open_[order], first[order], then[order]
        new_first = np.append(True, first[1:] != first[:-1])
        new = new_first | np.append(True, then[1:] != then[:-1])
        at = np.arange(len(open_))
        start = np.maximum.accumulate(np.where(new, at, 0))
        group_start = np.maximum.accumulate(np.where(new_first, at, 0))
        place[open_] = first + start - group_start
        alone = new & np.append(new[1:], True)
        open_ = open_[~alone]
        length *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[place] = np.arange(n)
    return suffixes, place


def common_prefixes(symbols: list[int], suffixes: list[int], place: list[int]) -> list[int]:
    """How much each suffix in order shares with the one before; 0 for the first."""
    n = len(symbols)
    shared, out = 0, [0] * n
    for at, rank in enumerate(place):
        if not rank:
            shared = 0
            continue
        other = suffixes[rank - 1]
        most = n - max(at, other)
        while shared < most and symbols[at + shared] == symbols[other + shared]:
            shared += 1
        out[rank] = shared
        if shared:
            shared -= 1
    return out


def branching_tandems(symbols: np.ndarray) -> list[tuple[int, int]]:
    """(start, period) of all squares that cannot be moved one to the right.

    Every interval of the suffixes in order whose members share a prefix of some depth, no less and
    no more, is gone through bottom-up, with a stack in place of a tree. Of its children all but the
    largest are looked into: a suffix i has a square beside it where i + depth, or i - depth, lies
    in the interval as well, which its place tells. That is n log n looks.
    """
    n = len(symbols)
    if n < 2:
        return []
    order, places = suffix_array(symbols)
    text, suffixes, place = symbols.tolist(), order.tolist(), places.tolist()
    shared = common_prefixes(text, suffixes, place)
    found: set[tuple[int, int]] = set()

    def look(depth: int, low: int, high: int, start: int, end: int) -> None:
        """Squares of that depth beside the suffixes at places start to end of interval low to high."""
        if end - start >= WIDE_CHILD:
            own = order[start:end]
            for step in (depth, -depth):
                other = own + step
                there = (other >= 0) & (other < n)
                first = np.minimum(own, other)[there]
                rank = places[other[there]]
                first = first[(rank >= low) & (rank < high)]
                last = first + 2 * depth
                apart = (last >= n) | (symbols[first + depth] != symbols[np.minimum(last, n - 1)])
                found.update((at, depth) for at in first[apart].tolist())
            return
        for rank in range(start, end):
            i = suffixes[rank]
            j = i + depth
            if j < n and low <= place[j] < high:
                if j + depth >= n or text[j] != text[j + depth]:
                    found.add((i, depth))
            j = i - depth
            if j >= 0 and low <= place[j] < high:
                if i + depth >= n or text[i] != text[i + depth]:
                    found.add((j, depth))

    # Of each open interval: its depth, where it starts, and its largest child yet.
    stack = [(0, 0, 0, 0)]
    for rank in range(1, n + 1):
        depth_here = shared[rank] if rank < n else 0
        start, child = rank - 1, (rank - 1, rank)
        while stack[-1][0] > depth_here:
            depth, low, big_low, big_high = stack.pop()
            if child[1] - child[0] > big_high - big_low:
                big_low, big_high = child
            look(depth, low, rank, low, big_low)
            look(depth, low, rank, big_high, rank)
            start, child = low, (low, rank)
        depth, low, big_low, big_high = stack[-1]
        if depth < depth_here:
            stack.append((depth_here, start, *child))
        elif child[1] - child[0] > big_high - big_low:
            stack[-1] = (depth, low, *child)
    return sorted(found)


def _reach(symbols: np.ndarray, start: int, period: int) -> int:
    """How far to the left of start symbols equal those a period on: squares rotated to the left."""
    step = 16
    while start > 0:
        low = max(0, start - step)
        same = symbols[low:start] == symbols[low + period : start + period]
        if not same.all():
            return start - int(np.argmin(same[::-1]))
        start, step = low, step * 2
    return start


def runs(symbols: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period.

    A run is a stretch with smallest period q, of max(least, 2q) symbols at least, that no neighbour
    extends keeping q. Its last square branches, and rotated to the left it gives the whole run.
    Squares that end at the same place and whose period is a multiple of a run's are in that run.
    """
    by_end: dict[int, list[int]] = {}
    for start, period in branching_tandems(symbols):
        by_end.setdefault(start + 2 * period, []).append(period)
    found = []
    for end, periods in by_end.items():
        own: list[tuple[int, int]] = []
        for period in sorted(periods):
            if any(period % q == 0 and begin <= end - 2 * period for begin, q in own):
                continue
            begin = _reach(symbols, end - 2 * period, period)
            own.append((begin, period))
            if end - begin >= least:
                found.append((begin, end - begin, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those in no run behind that run's first period."""
    gone = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return np.cumsum(gone[:n]) == 0


def with_period(words: list[str], doc_id: int | None) -> list[str]:
    """The words with a part repeated, if the id's checksum says so; as they are without an id."""
    if doc_id is None or not words:
        return words
    code = zlib.crc32(str(doc_id).encode())
    if code % 10:
        return words
    shift, n = code // 10, len(words)
    start = shift % n
    period = 1 + (n - start) // (3 + shift % 8)
    return words[:start] + [words[start + (at - start) % period] for at in range(start, n)]


_RUNS = pa.schema(
    [("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])))]
    + [("collapsed", pa.string())]
)
_DIGESTS = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
    + [(name, pa.string()) for name in ("runs_sha256", "collapsed_sha256")]
)


def _analysed(documents: DataFrame, id_col: str, text_col: str, planted: bool, schema: pa.Schema, row) -> DataFrame:
    def analyse(rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
        split = [_WORD.findall(text) for _, text in rows]
        if planted:
            split = [with_period(words, doc_id) for words, (doc_id, _) in zip(split, rows)]
        symbols = [numbered(words) for words in split]
        out = []
        for (doc_id, _), words, own, due in zip(rows, split, symbols, may_repeat(symbols).tolist()):
            found = runs(own) if due else []
            if found:
                stay = collapsed(len(words), found)
                words = [word for word, kept in zip(words, stay.tolist()) if kept]
            out.append((doc_id, *row(found, " ".join(words))))
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group: list[tuple[int | None, str]] = []
            size = 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                group.append((doc_id.as_py(), text.as_py() or ""))
                size += len(group[-1][1])
                if size >= GROUP_CHARS:
                    yield analyse(group)
                    group, size = [], 0
            if group:
                yield analyse(group)

    return documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).mapInArrow(run, from_arrow_schema(schema))


def periodic_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (array of start, length, period) and collapsed (the words outside of repetitions).

    Words are numbered from 0; runs are those of runs(), in its order. Of a run, the first period
    stays. collapsed holds the words left, joined by one space. Nothing is shuffled; each text is
    analysed as a whole, in memory in proportion to it. Null and empty texts have no words and no
    runs; ids may be null or repeat; other columns are not read. No rows, no rows.
    """
    return _analysed(
        documents, id_col, text_col, False, _RUNS,
        lambda found, text: ([dict(zip(("start", "length", "period"), run)) for run in found], text),
    )


def digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """periodic_runs() of texts in some of which a part is first repeated, see with_period().

    Per row: doc_id, n_runs, the longest run's start, length, period and exponent_milli (1000 times
    length over period; of equally long runs the first, then that of the smallest period; nulls
    without a run), runs_sha256 of all runs as lines, collapsed_sha256 of the collapsed text.
    """

    def row(found: list[tuple[int, int, int]], text: str) -> tuple:
        best = min(found, key=lambda run: (-run[1], run[0], run[2])) if found else (None, None, None)
        lines = "".join([f"{start},{length},{period}\n" for start, length, period in found])
        return (
            len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        )

    return _analysed(documents, id_col, text_col, True, _DIGESTS, row)
