"""Near duplicates: DartMinHash signatures, banded joining, and an exact check of every link."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.components import components
from sparkgate.llm.darts import bands, mix, signatures
from sparkgate.llm.exact import content
from sparkgate.llm.spread import spread_links
from sparkgate.llm.tables import Scratch, narrow_enough, salt, tidied

SHINGLE_WORDS, SIMILARITY = 5, 0.8
# 42 bands of 6 coordinates: two texts of similarity 0.8 share none with a chance of 3 in a million.
BANDS, BAND_ROWS = 42, 6
# Rounds in which a bucket's rows are compared with one of them, before those still apart are joined.
STAR_ROUNDS = 2
# Some bits of every coordinate, in words of 63, tell most pairs that are not alike apart. A pair
# whose agreeing coordinates are this many standard deviations below what is expected at the least
# similarity is not compared in full: 3 in a million links of just that similarity.
PLANES, SKETCH_WORDS, SKETCH_BITS, DEVIATIONS = 4, 4, 63, 4.5
# Words a worker remembers the hashes of.
KNOWN_WORDS = 50_000
# Texts are signed in groups of about so many characters.
GROUP_CHARS = 500_000

_WORD = re.compile("[^ \t-\r]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_known = WordHashes()


def shingles(words: list[str]) -> np.ndarray:
    """Hashes of all windows of five words, in order; of the whole if it is shorter; none of none."""
    if len(_known) > KNOWN_WORDS:
        _known.clear()
    codes = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE_WORDS, len(words))
    if not width:
        return codes
    code = np.zeros(len(words) - width + 1, np.uint64)
    for n in range(width):
        code = mix(code * _ODD + codes[n : len(words) - width + 1 + n])
    return code


def weighted(words: list[str], by_count: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights: how often they occur, or 1 each."""
    elements, counts = np.unique(shingles(words), return_counts=True)
    return elements, counts.astype(np.float64) if by_count else np.ones(len(elements))


def similarity(first: str, second: str, by_count: bool = False) -> float:
    """Weighted Jaccard similarity of two texts' shingles; 0 if one has none."""
    a, wa = weighted(_WORD.findall(first), by_count)
    b, wb = weighted(_WORD.findall(second), by_count)
    if not len(a) or not len(b):
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = np.minimum(wa[at_a], wb[at_b]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def digest(words: list[str]) -> bytes:
    """SHA-256 of the words, parted by one space."""
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def elements_of(words: list[str], by_count: bool) -> np.ndarray:
    """A set of hashes whose Jaccard similarity is that of the weighted shingles.

    With by_count the second and further occurrences of a shingle are elements of their own.
    """
    codes, counts = np.unique(shingles(words), return_counts=True)
    if not by_count or not len(codes):
        return codes
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    codes = np.repeat(codes, counts)
    return np.where(turn > 0, mix(codes + turn.astype(np.uint64) * _ODD), codes)


_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("h", pa.binary()), ("size", pa.float64())]
    + [("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
)
_ELEMENTS = pa.schema([("doc_id", pa.int64()), ("h", pa.binary()), ("elements", pa.list_(pa.int64()))])


def _groups(batch: pa.RecordBatch) -> Iterator[list[tuple[int | None, str]]]:
    """The batch's (doc_id, text), in groups of about GROUP_CHARS characters."""
    group: list[tuple[int | None, str]] = []
    size = 0
    for doc_id, text in zip(batch["doc_id"], batch["text"]):
        group.append((doc_id.as_py(), text.as_py() or ""))
        size += len(group[-1][1])
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _signed(texts: DataFrame, by_count: bool) -> DataFrame:
    """Per text: doc_id, h (digest of its words), size (total weight), band hashes and sketch."""

    def sign(rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
        split = [_WORD.findall(text) for _, text in rows]
        sets = [weighted(words, by_count) for words in split]
        full = [n for n, (elements, _) in enumerate(sets) if len(elements)]
        hashes: list[list[int]] = [[] for _ in rows]
        sketches: list[list[int]] = [[] for _ in rows]
        if full:
            owners = np.repeat(np.arange(len(full)), [len(sets[n][0]) for n in full])
            signature = signatures(
                np.concatenate([sets[n][0] for n in full]), owners,
                np.concatenate([sets[n][1] for n in full]), len(full), BANDS * BAND_ROWS,
            )
            planes = signature[:, None, :] >> np.arange(PLANES, dtype=np.uint64)[:, None] & np.uint64(1)
            bits = planes.astype(np.int64).reshape(len(full), PLANES * SKETCH_WORDS, SKETCH_BITS)
            words = (bits << np.arange(SKETCH_BITS)).sum(axis=2)
            codes = bands(signature, BAND_ROWS).view(np.int64)
            for n, code, sketch in zip(full, codes.tolist(), words.tolist()):
                hashes[n], sketches[n] = code, sketch
        columns = [[doc_id for doc_id, _ in rows], list(map(digest, split)), [float(w.sum()) for _, w in sets], hashes, sketches]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SIGNED)], schema=_SIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(batch):
                yield sign(group)
        _known.clear()

    return texts.mapInArrow(tidied(run), from_arrow_schema(_SIGNED))


def _elements(texts: DataFrame, by_count: bool) -> DataFrame:
    """Per text: doc_id, h and its set of elements."""

    def made(rows: list[tuple[int, str]]) -> pa.RecordBatch:
        sets, digests = [], []
        for _, text in rows:
            words = _WORD.findall(text)
            sets.append(elements_of(words, by_count).view(np.int64))
            digests.append(digest(words))
        ends = np.cumsum([0, *map(len, sets)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
        ids = pa.array([doc_id for doc_id, _ in rows], pa.int64())
        return pa.record_batch([ids, pa.array(digests, pa.binary()), lists], schema=_ELEMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(batch):
                yield made(group)
        _known.clear()

    return texts.mapInArrow(tidied(run), from_arrow_schema(_ELEMENTS))


def _may_be_alike(least: float) -> Column:
    """Whether sizes allow that similarity, and enough bits of the sketches agree."""
    sizes = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * (least - 1e-9)
    n, share = SKETCH_WORDS * SKETCH_BITS, least + (1 - least) / (1 << PLANES)
    most = n - math.floor(n * share - DEVIATIONS * math.sqrt(n * share * (1 - share)))
    unequal = [
        reduce(
            lambda x, y: x.bitwiseOR(y),
            [
                F.col("sketch_a")[plane * SKETCH_WORDS + word].bitwiseXOR(
                    F.col("sketch_b")[plane * SKETCH_WORDS + word]
                )
                for plane in range(PLANES)
            ],
        )
        for word in range(SKETCH_WORDS)
    ]
    return sizes & (sum([F.bit_count(x) for x in unequal[1:]], F.bit_count(unequal[0])) <= most)


def body(text: Column) -> Column:
    """The words of a text, each parted from the next by one space; none of null."""
    return F.trim(content(text))


class _Texts:
    """Signed rows, and what is known of their distinct texts.

    Each row has a number. A text, of any number of rows with the same words, goes by the smallest
    of its rows' numbers, its node.
    """

    def __init__(self, texts: DataFrame, by_count: bool, scratch: Scratch) -> None:
        self._texts, self._by_count, self._scratch = texts, by_count, scratch
        signed = _signed(texts, by_count).withColumn("salt", salt("doc_id")).withColumn("row", F.monotonically_increasing_id())
        self.signed = scratch.stage(signed, "signatures")
        named = self.signed.filter("doc_id IS NOT NULL")
        worded = named.filter("size > 0")
        # Of texts with several rows: by salt, so that a hot text's rows are dealt to many tasks.
        parts = worded.groupBy("h", "salt").agg(
            F.min("row").alias("part_node"), F.min("doc_id").alias("part_id"), F.count(F.lit(1)).alias("part_rows")
        )
        whole = parts.groupBy("h").agg(
            F.min("part_node").alias("node"), F.min("part_id").alias("first_id"), F.sum("part_rows").alias("rows")
        ).filter("rows > 1")
        groups = parts.select("h", "salt").join(whole.drop("rows"), "h")
        copies = worded.select("row", "h", "salt").join(groups, ["h", "salt"]).select("row", "node", "first_id")
        self.copies = scratch.stage(copies, "copies")
        others = scratch.stage(self.copies.filter("row <> node").select("row"), "others")
        self.firsts = worded.join(narrow_enough(others, 16), "row", "left_anti").withColumnRenamed("row", "node")
        often = named.groupBy("doc_id").count().filter("count > 1").select("doc_id")
        self.often = scratch.stage(often, "often")

    def nodes(self, rows: DataFrame) -> DataFrame:
        """Rows of signed with node and first_id, the smallest id of the text."""
        return rows.join(self.copies, "row", "left").withColumn("node", F.coalesce("node", "row")).withColumn(
            "first_id", F.coalesce("first_id", "doc_id")
        )

    def shared_ids(self) -> DataFrame:
        """doc_id and node of the texts with words whose id occurs more than once."""
        rows = self.signed.filter("doc_id IS NOT NULL AND size > 0").select("doc_id", "row")
        return self.nodes(rows.join(narrow_enough(self.often, 16), "doc_id", "left_semi")).select("doc_id", "node").distinct()

    def elements(self, members: DataFrame) -> DataFrame:
        """node, size and elements of the given nodes, each once."""
        known = self._scratch.stage(self.firsts.select("node", "doc_id", "h", "size").join(members, "node", "left_semi"), "known")
        ids = self._texts.join(narrow_enough(known.select("doc_id").distinct(), 16), "doc_id", "left_semi")
        rows = _elements(ids, self._by_count).join(narrow_enough(known, 64), ["doc_id", "h"])
        rows = self._scratch.stage(rows.select("doc_id", "node", "size", "elements"), "rows_of_members")
        if self.often.isEmpty():
            return rows.drop("doc_id")
        # A repeated row gives its text's elements again.
        often = narrow_enough(self.often, 16)
        once = rows.join(often, "doc_id", "left_semi").dropDuplicates(["node"])
        return self._scratch.stage(rows.join(often, "doc_id", "left_anti").union(once).drop("doc_id"), "elements")


def _star_links(
    together: DataFrame, members: DataFrame, elements: DataFrame, least: float, scratch: Scratch
) -> tuple[DataFrame, DataFrame | None]:
    """Links a, b between texts that rounds of comparing a bucket's rows with one of them find, as far
    as they are verified, and the rows of buckets that still hold several classes."""
    apart = together.withColumn("class_id", F.col("node"))
    links = None
    for turn in range(STAR_ROUNDS):
        pick = F.max if turn % 2 else F.min
        hearts = apart.groupBy("bucket").agg(pick("node").alias("heart"))
        pairs = apart.join(hearts, "bucket").filter("node <> heart").select("node", "heart", "class_id").distinct()
        classes = apart.select("node", "class_id").distinct()
        own = members.join(classes, "node") if turn else members.withColumn("class_id", F.col("node"))
        first = own.select(*[F.col(name).alias(f"{name}_a") for name in ("node", "class_id", "size", "sketch")])
        second = members.select(*[F.col(name).alias(f"{name}_b") for name in ("node", "size", "sketch")])
        likely = pairs.join(first, (F.col("heart") == F.col("node_a")) & (F.col("class_id") != F.col("class_id_a"))).join(
            second, (F.col("node") == F.col("node_b")) & _may_be_alike(least)
        )
        likely = scratch.stage(likely.select(F.col("heart").alias("a"), F.col("node").alias("b")), f"likely_{turn}")
        found = scratch.stage(_alike(likely, elements, "elements", least), f"links_{turn}")
        known = found if links is None else found.union(links)
        links = scratch.stage(components(known).filter("node <> class_id").select(F.col("class_id").alias("a"), F.col("node").alias("b")), f"stars_{turn}")
        joined = together.join(links.select(F.col("b").alias("node"), F.col("a").alias("class_id")), "node", "left").withColumn(
            "class_id", F.coalesce("class_id", "node")
        )
        mixed = joined.groupBy("bucket").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).filter("low <> high")
        apart = scratch.stage(joined.join(mixed.select("bucket"), "bucket", "left_semi"), f"apart_{turn}")
        scratch.drop(f"likely_{turn}", f"links_{turn}", f"apart_{turn - 1}", f"stars_{turn - 1}")
        if apart.isEmpty():
            return links, None
    return links, apart


def _alike(pairs: DataFrame, sets: DataFrame, column: str, least: float) -> DataFrame:
    """Of pairs (a, b), those whose sets have at least that similarity."""
    first = sets.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col(column).alias("set_a"))
    second = sets.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col(column).alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    alike = shared * (1 + least) >= (F.col("size_a") + F.col("size_b")) * least - 1e-6
    return pairs.join(first, "a").join(second, "b").filter(alike).select("a", "b")


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    least: float = SIMILARITY,
    by_count: bool = False,
    with_hash: bool = False,
) -> DataFrame:
    """Per row: doc_id, class_id (the smallest id of its class) and kept (whether that is itself).

    with_hash adds text_sha256, that of body(text).

    Texts are linked if the Jaccard similarity of their five-word shingles is least or more; classes
    are what links connect. Weights are 1 per distinct shingle, or with by_count how often it
    occurs. Rows with the same words form one class at once, and only one of them goes on.

    Rows that share a band's bucket are candidates, if sizes and sketches do not rule a link out.
    In star rounds each row of a bucket is compared with one of them; rows that links have joined
    since need no further comparison. What is still apart in a bucket afterwards goes through
    spread_links(), which passes over no link between classes and does not compare all pairs.

    Texts without words, null ones among them, are alone, as are rows with a null id. Texts of
    fewer than five words have one shingle. Rows that repeat an id are one document: each of its
    texts is compared, and all are linked. Other columns are not read. No rows, no classes.
    """
    texts = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    scratch = Scratch(documents.sparkSession, "near")
    known = _Texts(texts, by_count, scratch)
    links = known.shared_ids()
    links = links.join(links.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b"))
    found = _links(known, least, scratch)
    classes = components(links if found is None else links.union(found))
    classes = scratch.stage(classes.withColumnRenamed("class_id", "root"), "classes")

    # The smallest id of a class: of its texts' first ids.
    rows = known.nodes(known.signed.select("doc_id", "h", "size", "row"))
    roots = classes.select(F.col("node").alias("row"))
    tied = known.nodes(known.signed.select("doc_id", "row").join(roots, "row", "left_semi")).select("node", "first_id")
    of_root = classes.join(tied, "node").groupBy("root").agg(F.min("first_id").alias("class_id"))
    of_node = scratch.stage(classes.join(of_root, "root").select("node", "class_id"), "class_of_node")
    scratch.drop("classes")
    # Texts without words go with the others of their id.
    ids = known.shared_ids().join(of_node, "node").groupBy("doc_id").agg(F.min("class_id").alias("id_class"))
    return (
        rows.join(of_node, "node", "left")
        .join(narrow_enough(scratch.stage(ids, "class_of_id"), 32), "doc_id", "left")
        .withColumn("class_id", F.coalesce("class_id", "id_class", F.when(F.col("size") > 0, F.col("first_id")), "doc_id"))
        .withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")))
        .select(
            "doc_id",
            "class_id",
            F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
            *([F.lower(F.hex("h")).alias("text_sha256")] if with_hash else []),
        )
    )


def _links(known: _Texts, least: float, scratch: Scratch) -> DataFrame | None:
    """Verified links a, b that connect all candidate texts that are alike."""
    placed = known.firsts.select("node", F.explode("bands").alias("bucket"))
    shared = scratch.stage(placed.groupBy("bucket").count().filter("count > 1").select("bucket"), "shared")
    # Read from a shuffle, so that adaptive execution can split a hot bucket.
    together = scratch.stage(placed.join(narrow_enough(shared, 16), "bucket"), "together")
    scratch.drop("shared")
    if together.isEmpty():
        return None
    inside = scratch.stage(together.select("node").distinct(), "inside")
    members = scratch.stage(
        known.firsts.select("node", "size", "sketch").join(narrow_enough(inside, 16), "node", "left_semi"), "members"
    )
    elements = known.elements(inside)
    links, apart = _star_links(together, members, elements, least, scratch)
    if apart is not None:
        links = links.union(spread_links(apart, elements, least, scratch))
    return links
