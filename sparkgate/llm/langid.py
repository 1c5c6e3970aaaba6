"""Language identification: the family first, then one-versus-one linear SVMs inside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.tables import tidied

# Texts are described by their letter n-grams, hashed to so many places.
PLACES, LONGEST = 1 << 12, 3
# The machines are fitted on at most so many texts, dealt evenly to the languages, picked by hash.
FIT_TEXTS = 1_500
ROUNDS, RIDGE = 80, 1e-4
UNDETERMINED = "und"

# Families of language codes. A code not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nl no nb nn sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "turkic": "az kk tr uz",
    "semitic": "ar he mt",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], lang)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray | None:
    """A text as a unit vector: roots of its n-grams' shares. None if it has no letter.

    Case is folded; each run of other characters than letters counts as one gap between words.
    """
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[chars]
    if not letter.any():
        return None
    chars = np.where(letter, chars, 32)[letter | np.append(True, letter[:-1])]
    chars = np.concatenate([[32], chars, [32]]).astype(np.uint32)
    counts = np.zeros(PLACES)
    code = np.zeros(len(chars), np.uint32)
    for n in range(1, LONGEST + 1):
        code = code[: len(chars) - n + 1] * np.uint32(0x9E3779B1) + chars[n - 1 :] + np.uint32(n)
        mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        counts += np.bincount((mixed >> np.uint32(20)).astype(np.int64), minlength=PLACES)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


@dataclass
class Machine:
    """A linear support vector machine: positive on the first side, negative on the second."""

    weights: np.ndarray
    bias: float
    steepness: float

    @classmethod
    def fit(cls, rows: np.ndarray, first: np.ndarray) -> Machine:
        """Squared hinge loss with a ridge, by accelerated gradient steps; both sides weigh alike."""
        signs = np.where(first, 1.0, -1.0).astype(np.float32)
        share = np.where(first, 0.5 / max(first.sum(), 1), 0.5 / max((~first).sum(), 1)).astype(np.float32)
        weights, ahead = np.zeros((2, rows.shape[1]), np.float32)
        bias = ahead_bias = 0.0
        pace, step = 1.0, 1 / (2 * (2.0 + RIDGE))
        for _ in range(ROUNDS):
            pull = 2 * share * signs * np.maximum(0, 1 - signs * (rows @ ahead + ahead_bias))
            moved = ahead - step * (RIDGE * ahead - pull @ rows)
            moved_bias = ahead_bias + step * float(pull.sum())
            faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            gain = (pace - 1) / faster
            ahead = (moved + gain * (moved - weights)).astype(np.float32)
            ahead_bias = moved_bias + gain * (moved_bias - bias)
            weights, bias, pace = moved.astype(np.float32), moved_bias, faster
        margins = signs * (rows @ weights + bias)
        # How margins become probabilities: the slope with the least log loss on the fitted rows.
        slopes = [0.5, 1, 2, 4, 8]
        losses = [np.sum(share * np.log1p(np.exp(-np.clip(a * margins, -50, 50)))) for a in slopes]
        return cls(weights, bias, slopes[int(np.argmin(losses))])

    def chance(self, row: np.ndarray) -> float:
        """Probability of the first side."""
        return 1 / (1 + np.exp(-np.clip(self.steepness * (row @ self.weights + self.bias), -50, 50)))


@dataclass
class OneVersusOne:
    """Machines for every pair of classes; the class with most wins is taken."""

    classes: list[str]
    machines: dict[tuple[int, int], Machine] = field(default_factory=dict)

    @classmethod
    def fit(cls, rows: np.ndarray, names: np.ndarray) -> OneVersusOne:
        made = cls(sorted(set(names.tolist())))
        for a, b in combinations(range(len(made.classes)), 2):
            of_a, of_b = names == made.classes[a], names == made.classes[b]
            both = of_a | of_b
            made.machines[a, b] = Machine.fit(rows if both.all() else rows[both], of_a[both])
        return made

    def pick(self, row: np.ndarray) -> tuple[str, float]:
        """The class and its least probability against any other. Equal wins: more summed odds."""
        n = len(self.classes)
        wins, odds, least = [0] * n, [0.0] * n, [1.0] * n
        for (a, b), machine in self.machines.items():
            p = float(machine.chance(row))
            for side, chance in ((a, p), (b, 1 - p)):
                wins[side] += chance >= 0.5
                odds[side] += chance
                least[side] = min(least[side], chance)
        best = max(range(n), key=lambda c: (wins[c], odds[c], -c))
        return self.classes[best], least[best]


@dataclass
class LanguageModel:
    """Families against each other, and languages inside each family."""

    families: OneVersusOne
    inside: dict[str, OneVersusOne]

    def predict(self, text: str | None) -> tuple[str, float]:
        row = grams(text)
        if row is None or not self.families.classes:
            return UNDETERMINED, 0.0
        family, sure = self.families.pick(row)
        lang, surer = self.inside[family].pick(row)
        return lang, min(1.0, max(0.0, sure * surer))


def fit_model(langs: list[str], rows: np.ndarray) -> LanguageModel:
    """A model from languages and their texts' unit vectors; without any it determines nothing."""
    if not langs:
        return LanguageModel(OneVersusOne([]), {})
    names = np.array(langs, dtype=object)
    families = np.array([family_of(lang) for lang in langs], dtype=object)
    inside = {f: OneVersusOne.fit(rows[families == f], names[families == f]) for f in sorted(set(families.tolist()))}
    return LanguageModel(OneVersusOne.fit(rows, families), inside)


_VECTORS = pa.schema([("lang", pa.string()), ("vector", pa.binary())])
_PREDICTED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
)


def held_out(id_col: str) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learned(documents: DataFrame) -> LanguageModel:
    """A model of documents (doc_id, text, lang), of those that are not held out.

    Languages are counted over all of them; then each gives its share of FIT_TEXTS, by hash of id
    and text, so that no language's rows gather anywhere. Some 10 % over the share may come.
    """
    usable = documents.filter(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {row["lang"]: row["count"] for row in usable.groupBy("lang").count().collect()}
    if not counts:
        return fit_model([], np.zeros((0, PLACES), np.float32))
    share = max(1, FIT_TEXTS // len(counts))
    spread = 1 << 30
    limits = {lang: min(spread, spread * share // n + 1) for lang, n in counts.items()}
    limit = F.create_map(*[x for lang, most in limits.items() for x in (F.lit(lang), F.lit(most))])[F.col("lang")]
    picked = usable.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(spread)) < limit)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang, grams(text)) for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist())]
            rows = [(lang, row.astype(np.float16).tobytes()) for lang, row in rows if row is not None]
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _VECTORS)], schema=_VECTORS)

    rows = picked.select("lang", "text").mapInArrow(tidied(vectors), from_arrow_schema(_VECTORS)).collect()
    # An order of their own, so that the model does not depend on how rows arrive.
    found = sorted((row["lang"], bytes(row["vector"])) for row in rows)
    packed = np.frombuffer(b"".join(vector for _, vector in found), np.float16)
    return fit_model([lang for lang, _ in found], packed.astype(np.float32).reshape(-1, PLACES))


def body(text: Column) -> Column:
    """Text as it is judged; null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def languages(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    with_hash: bool = False,
) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score (0 to 1, how sure the path to it was).

    with_hash adds text_sha256, that of body(text).

    Learns from rows with a language that are not held out, and predicts from whole texts alone.
    Null texts and texts without a letter are und with score 0, as are all texts if there is
    nothing to learn from. A null id is not held out. Ids may repeat. Other columns are not read.
    """
    texts = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    model = learned(texts)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    hashes = [("text_sha256", pa.string())] if with_hash else []
    schema = pa.schema([*_PREDICTED, *[pa.field(*h) for h in hashes]])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(text.as_py()) for text in batch["text"]]
            langs, scores = [lang for lang, _ in found], [score for _, score in found]
            columns = [batch["doc_id"], batch["held_out"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns + [batch[name] for name, _ in hashes], schema=schema)

    told = [F.sha2(body(F.col("text")), 256).alias(name) for name, _ in hashes]
    return texts.select("doc_id", held_out("doc_id").alias("held_out"), "text", *told).mapInArrow(
        tidied(predict), from_arrow_schema(schema)
    )
