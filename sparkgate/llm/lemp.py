"""Hard negatives: large inner products by length buckets and sorted coordinate lists."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.tables import narrow_enough, stage

POSITIVES, NEGATIVES = 5, 3
# A negative scores from 50 to 95 hundredths of its positive.
LEAST_SHARE, MOST_SHARE = 50, 95
SCALE = 256
# Lengths in a bucket differ by this factor at most.
BUCKET_STEP = 1.1
# A bucket is dealt to parts of about so many components, each searched by one task at a time.
PART_CELLS = 1 << 19
# Coordinates of an anchor, its largest, whose feasible ranges are looked at.
FOCUS = 5
# Anchors that are multiplied with a part at once.
BLOCK_ANCHORS = 256
# Allowance for rounding in cosines; products themselves are exact.
_SLACK = 1e-9

_WANT = pa.struct([("positive_id", pa.int64()), ("score", pa.int64()), ("least", pa.int64())])
_FOUND = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "row_id", "score")])


def products(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: by doubles if all are whole there, else by Python's integers."""
    high = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (first, second)]
    if max(first.shape[1], 1) * high[0] * high[1] < 1 << 52:
        return (first.astype(np.float64) @ second.T.astype(np.float64)).astype(np.int64)
    return first.astype(object) @ second.T.astype(object)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, higher ones first, of equal ones the first."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        at = np.sort(np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]]))
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


class LengthBucket:
    """Rows of about one length, by id, with a sorted list of values for each coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        values = self.vectors.astype(np.float64)
        lengths = np.sqrt((values**2).sum(axis=1))
        self.longest = float(lengths.max(initial=0))
        unit = values / np.where(lengths > 0, lengths, 1)[:, None]
        # By coordinate: its rows in order of value, and the values.
        self._rows = np.argsort(unit, axis=0).T.copy()
        self._values = np.take_along_axis(unit.T, self._rows, axis=1)
        by_label = np.argsort(self.labels, kind="stable")
        cuts = np.flatnonzero(np.diff(self.labels[by_label])) + 1
        self._of_label = {int(self.labels[part[0]]): part for part in np.split(by_label, cuts) if len(part)}

    def of_label(self, label: int) -> np.ndarray:
        return self._of_label.get(label, np.array([], np.int64))

    def candidates(self, anchor: np.ndarray, least: float | None) -> np.ndarray | None:
        """Rows whose product with the anchor may reach least; None where nothing rules any out.

        Between unit vectors at a cosine of c or more, angles to an axis differ by arccos c at
        most. So each focus coordinate of the anchor leaves a range of values, which is a stretch
        of that coordinate's list. Rows in all stretches are candidates.
        """
        length = math.sqrt(float((anchor**2).sum()))
        if least is None or least <= 0:
            return None
        if length * self.longest * (1 + _SLACK) < least:
            return np.array([], np.int64)
        turn = math.acos(min(1.0, max(0.0, least / (length * self.longest) - _SLACK)))
        unit = anchor / length
        hits, met = None, 0
        for axis in np.argsort(-np.abs(unit))[:FOCUS].tolist():
            angle = math.acos(max(-1.0, min(1.0, unit[axis])))
            low = math.cos(min(math.pi, angle + turn)) - _SLACK
            high = math.cos(max(0.0, angle - turn)) + _SLACK
            start, end = np.searchsorted(self._values[axis], [low, high + _SLACK])
            if end - start < len(self.ids):
                hits = np.zeros(len(self.ids), np.int8) if hits is None else hits
                hits[self._rows[axis, start:end]] += 1
                met += 1
        return None if hits is None else np.flatnonzero(hits == met)


@dataclass
class Anchors:
    """Anchors of a block: ids, labels, vectors and what each of them wants."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    wants: list[list[dict]]


# One found row: anchor, positive and its score (null when looking for positives), row, score.
Found = tuple[int, int | None, int | None, int, int]
Search = Callable[[LengthBucket, Anchors], Iterator[Found]]


def _scored(bucket: LengthBucket, block: Anchors, least: list[float | None], same: bool) -> Iterator[tuple]:
    """(number of anchor, rows, scores) of the candidates with the anchor's label, or without it.

    Anchors that no range helps are multiplied together with all rows that they may meet.
    """
    every = np.arange(len(bucket.ids))
    open_: dict[int, list[int]] = {}
    for n, (anchor, floor) in enumerate(zip(block.vectors.astype(np.float64), least)):
        rows = bucket.candidates(anchor, floor)
        if rows is None:
            open_.setdefault(int(block.labels[n]), []).append(n)
            continue
        rows = rows[((bucket.labels[rows] == block.labels[n]) == same) & (bucket.ids[rows] != block.ids[n])]
        if len(rows):
            yield n, rows, products(block.vectors[n : n + 1], bucket.vectors[rows])[0]
    for label, members in open_.items():
        rows = bucket.of_label(label) if same else every[bucket.labels != label]
        if not len(rows):
            continue
        scores = products(block.vectors[members], bucket.vectors[rows])
        for n, own in zip(members, scores):
            other = bucket.ids[rows] != block.ids[n]
            yield n, rows[other], own[other]


def find_positives(bucket: LengthBucket, block: Anchors) -> Iterator[Found]:
    """Per anchor, the best rows of its label that reach the score it already knows of, if any."""
    least = [want[0]["least"] if want else None for want in block.wants]
    for n, rows, scores in _scored(bucket, block, least, same=True):
        for at in best(scores, POSITIVES):
            if least[n] is None or scores[at] >= least[n]:
                yield int(block.ids[n]), None, None, int(bucket.ids[rows[at]]), scores[at]


def share(score: int) -> tuple[int, int]:
    """The least and the most that a negative scores beside a positive of this score."""
    return -(-LEAST_SHARE * score // 100), MOST_SHARE * score // 100


def find_negatives(bucket: LengthBucket, block: Anchors) -> Iterator[Found]:
    """Per anchor and positive, the best rows of other labels within the positive's share."""
    floors = [[max(share(w["score"])[0], w["least"] if w["least"] is not None else 0) for w in ws] for ws in block.wants]
    least = [min(own) if own else None for own in floors]
    for n, rows, scores in _scored(bucket, block, least, same=False):
        for want, floor in zip(block.wants[n], floors[n]):
            within = np.flatnonzero((scores >= floor) & (scores <= share(want["score"])[1]))
            for at in within[best(scores[within], NEGATIVES)]:
                yield int(block.ids[n]), want["positive_id"], want["score"], int(bucket.ids[rows[at]]), scores[at]


def _matrix(cells: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of equal width; what is missing at their ends is 0."""
    sizes = np.diff(cells.offsets.to_numpy()).astype(np.int64)
    flat = cells.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _table(found: list[Found]) -> pa.RecordBatch:
    limit = np.iinfo(np.int64)
    rows = [(a, p, s, r, max(limit.min, min(limit.max, int(score)))) for a, p, s, r, score in found]
    return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5, schema=_FOUND)


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[Anchors]:
    for start in range(0, len(batch), BLOCK_ANCHORS):
        part = batch.slice(start, BLOCK_ANCHORS)
        yield Anchors(
            part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(part["cells"], width),
            [want or [] for want in part["wants"].to_pylist()],
        )


@dataclass
class Index:
    """All rows, dealt to parts of their length bucket: the longest bucket has the first parts."""

    rows: DataFrame
    width: int
    n_parts: int
    # By bucket, longest first: the most its rows' length can be, and parts up to its end.
    tops: list[float]
    ends: list[int]

    def meeting(self, anchors: DataFrame, search: Search) -> DataFrame:
        """What search finds for each anchor in each part that can hold such a row.

        A part's rows come before its anchors in one sorted task, which holds the part and streams
        the anchors. Parts of rows too short for an anchor's least score are not visited.
        """
        if not self.n_parts:
            return anchors.sparkSession.createDataFrame([], from_arrow_schema(_FOUND))
        width = self.width
        cut = F.col("least") / F.greatest("length", F.lit(1.0)) * (1 - _SLACK)
        tops = F.array(*[F.lit(top) for top in self.tops])
        ends = F.array(*[F.lit(end) for end in self.ends])
        long_enough = F.size(F.filter(tops, lambda top: top >= cut))
        last = F.when(F.coalesce(F.col("least"), F.lit(0)) <= 0, F.lit(self.n_parts)).when(
            long_enough > 0, F.element_at(ends, F.greatest(long_enough, F.lit(1)))
        )
        visiting = anchors.withColumn("last", last).filter("last IS NOT NULL").select(
            F.explode(F.sequence(F.lit(0), F.col("last") - 1)).alias("part"), F.lit(1).alias("kind"),
            "vec_id", "label", "cells", "wants",
        )
        own = self.rows.select("part", F.lit(0).alias("kind"), "vec_id", "label", "cells", F.lit(None).alias("wants"))
        dealt = own.union(visiting).repartition(self.n_parts, "part").sortWithinPartitions("part", "kind", "vec_id")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            part, bucket = None, None
            for batch in batches:
                parts, kinds = batch["part"].to_numpy(), batch["kind"].to_numpy()
                cuts = np.flatnonzero((parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1])) + 1
                edges = [0, *cuts.tolist(), len(batch)]
                for start, end in zip(edges, edges[1:]):
                    if start == end:
                        continue
                    piece = batch.slice(start, end - start)
                    if parts[start] != part:
                        part, bucket, held = parts[start], None, []
                    if not kinds[start]:
                        held.append(piece)
                        continue
                    if not held and bucket is None:
                        continue
                    if bucket is None:
                        bucket, held = _bucket(held, width), []
                    for block in _blocks(piece, width):
                        yield _table(list(search(bucket, block)))

        return dealt.mapInArrow(run, from_arrow_schema(_FOUND))

    def first_part(self) -> LengthBucket:
        """The first part, whose size PART_CELLS bounds."""
        rows = self.rows.filter("part = 0").select("vec_id", "label", "cells").toArrow()
        return _bucket(rows.combine_chunks().to_batches(), self.width)


def _bucket(batches: list[pa.RecordBatch], width: int) -> LengthBucket:
    none = np.array([], np.int64)
    if not batches:
        return LengthBucket(none, none, np.zeros((0, width), np.int64))
    return LengthBucket(
        np.concatenate([b["vec_id"].to_numpy() for b in batches]),
        np.concatenate([b["label"].to_numpy() for b in batches]),
        np.concatenate([_matrix(b["cells"], width) for b in batches]),
    )


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """vec_id, label and cells (the scaled components) of the rows that take part, one per id."""
    named = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    limit = F.lit(float("inf"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = named.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    rows = rows.select("vec_id", "label", F.transform("vector", lambda x: F.floor(x * SCALE)).alias("cells"))
    often = stage(rows.groupBy("vec_id").count().filter("count > 1").select("vec_id"), "often")
    often = narrow_enough(often, 16)
    least = rows.join(often, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "cells")).alias("row"))
    return rows.join(often, "vec_id", "left_anti").union(least.select("vec_id", "row.label", "row.cells"))


def indexed(rows: DataFrame) -> Index:
    """The rows of _usable() with length, bucket and part.

    Buckets are powers of BUCKET_STEP, so their number is bounded by the range of lengths; only
    their counts reach the driver. A bucket's rows go to its parts by hash of the id, which parts
    equal vectors too.
    """
    length = F.sqrt(F.aggregate("cells", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    bucket = F.when(F.col("length") > 0, F.ceil(F.log("length") / math.log(BUCKET_STEP))).otherwise(-1)
    stored = stage(rows.withColumn("length", length).withColumn("bucket", bucket.cast("int")), "vectors")
    counted = stored.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("cells")).alias("width")).collect()
    counted.sort(key=lambda row: -row["bucket"])
    width = max((row["width"] for row in counted), default=0)
    parts = [-(-row["n"] * max(width, 1) // PART_CELLS) for row in counted]
    ends = np.cumsum(parts, dtype=np.int64).tolist()
    part = F.lit(None).cast("long")
    for row, n, end in zip(counted, parts, ends):
        own = F.lit(end - n) + F.pmod(F.xxhash64("vec_id"), F.lit(n))
        part = F.when(F.col("bucket") == row["bucket"], own).otherwise(part)
    tops = [BUCKET_STEP ** row["bucket"] * (1 + _SLACK) for row in counted]
    return Index(stored.withColumn("part", part.cast("int")), width, ends[-1] if ends else 0, tops, ends)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each key, with their rank from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _seeded(anchors: DataFrame, bucket: LengthBucket, width: int, search: Search, k: int) -> DataFrame:
    """anchor_id, positive_id and least, the k-th best score that the bucket holds, where it holds k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch, width):
                yield _table(list(search(bucket, block)))

    found = anchors.select("vec_id", "label", "cells", "wants").mapInArrow(run, from_arrow_schema(_FOUND))
    return found.groupBy("anchor_id", "positive_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= k
    )


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    label: Column | None = None,
    is_anchor: Column | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Scores are inner products of components times SCALE, rounded down. An anchor's positives are the
    POSITIVES best other rows of its label; a positive's negatives are the NEGATIVES best rows of
    other labels that score from LEAST_SHARE to MOST_SHARE hundredths of it; equal scores go by
    smaller id. label is a column of the input, is_anchor one over vec_id, label and cells (the
    scaled components); by default each row is an anchor.

    Rows are dealt to length buckets and these to parts. Each anchor meets the first part, of
    bounded size, on its own; the scores found there bound what other parts must reach, which rules
    out whole buckets by length and rows by their coordinates. The rest is verified exactly.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Of
    rows that repeat an id, that of the least label, then vector, takes part. Shorter vectors end
    in zeros. Scores beyond long are given as the nearest long. Positives without a negative, and
    anchors without a positive, have no row. Other columns are not read. No rows, no rows.
    """
    index = indexed(_usable(vectors, id_col, vector_col, F.col("label") if label is None else label))
    anchors = index.rows.select("vec_id", "label", "cells", "length")
    anchors = stage(anchors if is_anchor is None else anchors.filter(is_anchor), "anchors")
    wants = from_arrow_schema(pa.schema([("wants", pa.list_(_WANT))]))["wants"].dataType
    start = index.first_part()

    seeds = _seeded(anchors.withColumn("wants", F.lit(None).cast(wants)), start, index.width, find_positives, POSITIVES)
    seeded = anchors.join(seeds.select(F.col("anchor_id").alias("vec_id"), "least"), "vec_id", "left").withColumn(
        "wants", F.array(F.struct(F.lit(None).cast("long"), F.lit(None).cast("long"), "least")).cast(wants)
    )
    found = index.meeting(seeded, find_positives)
    positives = stage(_ranked(found, ["anchor_id"], POSITIVES).select("anchor_id", "row_id", "score"), "positives")

    # No score lies from 50 to 95 hundredths of a negative one.
    of_anchor = positives.filter("score >= 0").select(
        F.col("anchor_id").alias("vec_id"), F.col("row_id").alias("positive_id"), "score"
    )
    unseeded = anchors.join(
        of_anchor.groupBy("vec_id").agg(
            F.collect_list(F.struct("positive_id", "score", F.lit(None).cast("long").alias("least"))).cast(wants).alias("wants")
        ), "vec_id",
    )
    seeds = _seeded(unseeded, start, index.width, find_negatives, NEGATIVES)
    known = of_anchor.join(
        seeds.select(F.col("anchor_id").alias("vec_id"), "positive_id", "least"), ["vec_id", "positive_id"], "left"
    ).withColumn("lowest", F.greatest(
        F.coalesce("least", F.lit(0)).cast("double"), F.col("score").cast("double") * (LEAST_SHARE / 100 * (1 - _SLACK))
    ))
    seeded = anchors.join(
        known.groupBy("vec_id").agg(
            F.collect_list(F.struct("positive_id", "score", "least")).cast(wants).alias("wants"), F.min("lowest").alias("least")
        ), "vec_id",
    )
    found = index.meeting(seeded, find_negatives)
    return _ranked(found, ["anchor_id", "positive_id"], NEGATIVES).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def mined(embeddings: DataFrame) -> DataFrame:
    """hard_negatives() with every fiftieth id as an anchor and every seventh under the next label."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings, label=shifted, is_anchor=F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH taking_part AS (
    SELECT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS cells
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
           list_inner_product(a.cells, r.cells)::BIGINT AS score
    FROM taking_part a JOIN taking_part r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.row_id)::INTEGER AS rank,
       s.row_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
