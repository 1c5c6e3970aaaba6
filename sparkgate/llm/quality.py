"""Quality rules: statistics of rules per document, judged by an isolation forest."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.tables import stage

# The forest is fitted on labelled rows: at most so many good ones, and a few bad ones, so that
# what marks bad rows varies in the sample without being common in it. Picked by hash of the id.
FIT_GOOD, FIT_BAD = 4_000, 200
TREES, TREE_ROWS = 100, 128
SEED = 20240501
# The threshold loses at most this share of the good labelled rows, all of which are looked at.
GOOD_LOSS = 0.004
SCORE_BINS = 1_000

WINDOW = 5
_WORD = re.compile("[^ \t-\r]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")

_STATISTICS = pa.schema(
    [("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_())]
    + [(name, pa.float64()) for name in ("mean_word", "junk_rate")]
)
FEATURES = _STATISTICS.names[7:]
_JUDGED = pa.schema([*list(_STATISTICS)[:7], ("anomaly", pa.float64()), ("bin", pa.int64()), ("kept", pa.bool_())])


def repeated_words(ids: np.ndarray, width: int = WINDOW) -> int:
    """How many words lie in windows of width words that occur twice or more."""
    n = len(ids)
    if n <= width:
        return 0
    # Windows get numbers step by step, each from the number of the window one word shorter.
    code, many = ids, int(ids.max()) + 1
    for step in range(1, width):
        _, code = np.unique(code[: n - step] * many + ids[step:], return_inverse=True)
    often = np.bincount(code) > 1
    hits = np.flatnonzero(often[code])
    if not len(hits):
        return 0
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, hits, 1)
    np.add.at(edges, hits + width, -1)
    return int((np.cumsum(edges) > 0).sum())


def text_statistics(text: str | None) -> tuple:
    """The rules' counts and rates of one text, in the order of _STATISTICS without the id.

    The forest sees two rates: the mean length of words, and junk. Junk is the sum of symbols, words
    in capitals and words that repeat the one before, per word; of words in repeated windows, per
    word; and of repeated lines, per line. As one sum a page of a little of each stands out, and
    good pages that repeat a line do not: on their own such rare rates part good pages from good.
    """
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    chars = sum(map(len, words))
    symbols = len(_SYMBOL.findall(text))
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(ids) if len(numbers) < n else 0
    upper = sum(map(str.isupper, words))
    stutter = int((ids[1:] == ids[:-1]).sum())
    some = max(n, 1)
    return (
        n, chars, symbols, dup_lines, repeats,
        n < 10 or 100 * repeats > 20 * n,
        chars / some, (symbols + upper + stutter + repeats) / some + dup_lines / max(len(lines), 1),
    )


def statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, rates and the verdict of the fixed rules for every text, see _STATISTICS."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_statistics(text.as_py()) for text in batch["text"]]
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(_STATISTICS)[1:])]
                yield pa.record_batch([batch["doc_id"], *columns], schema=_STATISTICS)

    return documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).mapInArrow(measure, from_arrow_schema(_STATISTICS))


def _mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a tree of n rows."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass
class Forest:
    """Trees as flat arrays: a node's feature (-1 in a leaf), split, children and path length."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    roots: list[int]
    norm: float

    @classmethod
    def fit(cls, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
        """Trees of random splits, each over its own sample of the rows."""
        rng = np.random.default_rng(seed)
        size = min(tree_rows, len(rows))
        deepest = max(1, math.ceil(math.log2(max(size, 2))))
        nodes: list[list] = []

        def grow(part: np.ndarray, depth: int) -> int:
            number = len(nodes)
            nodes.append([-1, 0.0, 0, 0, depth + _mean_path(len(part))])
            low, high = part.min(axis=0), part.max(axis=0)
            varying = np.flatnonzero(high > low)
            if depth < deepest and len(part) > 1 and len(varying):
                feature = int(rng.choice(varying))
                split = float(rng.uniform(low[feature], high[feature]))
                under = part[:, feature] < split
                if under.any() and not under.all():
                    nodes[number][:2] = [feature, split]
                    nodes[number][2] = grow(part[under], depth + 1)
                    nodes[number][3] = grow(part[~under], depth + 1)
            return number

        roots = [grow(rows[rng.choice(len(rows), size, replace=False)], 0) for _ in range(trees)]
        feature, split, left, right, path = (np.array(column) for column in zip(*nodes))
        return cls(feature, split, left, right, path, roots, max(_mean_path(size), 1e-9))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1: short mean paths score high."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            active = every
            while len(active):
                at = node[active]
                inner = self.feature[at] >= 0
                active, at = active[inner], at[inner]
                under = rows[active, self.feature[at]] < self.split[at]
                node[active] = np.where(under, self.left[at], self.right[at])
            total += self.path[node]
        return 2.0 ** (-total / len(self.roots) / self.norm)


def score_bin(scores: np.ndarray) -> np.ndarray:
    """The bins scores are counted in and compared by."""
    return np.ceil(scores * SCORE_BINS).astype(np.int64)


def _anomalies(stats: DataFrame, forest: Forest | None, most: int) -> DataFrame:
    """Rows with their anomaly, kept if they pass the fixed rules and score in bin most at most."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch[name].to_numpy(zero_copy_only=False) for name in FEATURES])
            scores = forest.scores(rows) if forest else np.zeros(len(rows))
            failed = batch["base_failed"].to_numpy(zero_copy_only=False)
            bins = score_bin(scores)
            kept = ~failed & (bins <= most)
            head = [batch[name] for name in _JUDGED.names[:7]]
            yield pa.record_batch([*head, pa.array(scores), pa.array(bins), pa.array(kept)], schema=_JUDGED)

    return stats.mapInArrow(judge, from_arrow_schema(_JUDGED))


def threshold(good: np.ndarray, bad: np.ndarray) -> int:
    """The bin that scores may reach, from how many labelled rows of either kind lie in each bin.

    Of those that lose no more good rows than GOOD_LOSS it is the one that parts the labels best,
    of equally good ones the highest. Without rows of one kind it is the highest bin: nothing tells
    what is anomalous.
    """
    if not good.sum() or not bad.sum():
        return SCORE_BINS
    lost, caught = (1 - np.cumsum(counts) / counts.sum() for counts in (good, bad))
    gain = np.where(lost <= GOOD_LOSS, caught - lost, -1.0)
    return int(np.flatnonzero(gain == gain.max())[-1])


def fitted(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> tuple[Forest | None, int]:
    """The forest and its threshold, from labelled statistics.

    The forest sees a bounded sample; the threshold is set on the scores of all labelled rows that
    pass the fixed rules, as counts per score bin, see threshold(). Rows are compared with it by
    their bins, so rows of equal scores share a verdict. Without labelled rows there is no forest.
    """
    told = labels.select(F.col("doc_id"), F.col(label_col).alias("label")).filter("label IS NOT NULL").distinct()
    known = stage(stats.join(told, "doc_id").filter("NOT base_failed"), "labelled")

    def sample(label: int, most: int) -> list:
        rows = known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(most)
        return rows.select(*FEATURES).collect()

    rows = sample(1, FIT_GOOD) + sample(0, FIT_BAD)
    if not rows:
        return None, SCORE_BINS
    forest = Forest.fit(np.array(rows, float))
    scored = _anomalies(known.drop("label"), forest, SCORE_BINS).select("doc_id", "bin").join(told, "doc_id")
    counts = np.zeros((2, SCORE_BINS + 1))
    for row in scored.groupBy("bin", "label").count().collect():
        if row["label"] in (0, 1):
            counts[int(row["label"]), min(row["bin"], SCORE_BINS)] += row["count"]
    return forest, threshold(counts[1], counts[0])


def judged(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the counts, base_failed, anomaly (0 to 1) and kept.

    Statistics are taken of all whole texts in one pass and stored; the forest and its threshold
    come from those with a label. Null and empty texts have no words and fail the fixed rules.
    Null labels and labels of unknown documents are passed over; with labels of one kind only,
    nothing is anomalous. Equal statistics give equal scores and one verdict. Ids may be null or
    repeat; each row is judged by its own text. Other columns are not read.
    """
    stats = stage(statistics(documents, id_col, text_col), "statistics")
    forest, most = fitted(stats, labels)
    return _anomalies(stats, forest, most).drop("bin")
