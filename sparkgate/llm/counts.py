"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.vocabulary import tokenizer_path

# Pre-tokens a worker remembers; beyond that it starts anew.
KNOWN_TOKENS = 300_000
# Documents are counted in groups of about so many characters.
GROUP_CHARS = 4_000_000
# A character of no piece costs this much more than the rarest piece.
UNKNOWN_PENALTY = 10.0

WORD_START = "▁"
_WORD = re.compile("[^ \t-\r]+")
_CHARS = 0x110000


def unigram_scores(path: str) -> dict[str, float]:
    """Log probabilities of a sentencepiece file's pieces: by their rank, after Zipf's law.

    The file's own scores are ranks of merges, not probabilities. Control and byte pieces are left
    out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked = [
        model.id_to_piece(n)
        for n in range(model.get_piece_size())
        if not (model.is_control(n) or model.is_unknown(n) or model.is_byte(n) or model.is_unused(n))
    ]
    norm = math.log(sum(1 / (rank + 1) for rank in range(len(ranked))))
    return {piece: -math.log(rank + 1) - norm for rank, piece in enumerate(ranked)}


def _repeat(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ragged rows of these lengths: the row of each element, and its place in the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


class UnigramCounter:
    """How many tokens the best-scoring segmentation of a pre-token has.

    Of equal scores the one with fewer tokens wins, which is all a count depends on. A character
    without a piece of its own may stand alone, as many tokens as it has bytes in UTF-8.
    """

    def __init__(self, scores: dict[str, float]) -> None:
        numbers = {"": 0}
        for piece in scores:
            for end in range(1, len(piece) + 1):
                numbers.setdefault(piece[:end], len(numbers))
        self._score = np.full(len(numbers), -np.inf)
        for piece, score in scores.items():
            self._score[numbers[piece]] = score
        steps = sorted((numbers[p[:-1]] * _CHARS + ord(p[-1]), n) for p, n in numbers.items() if p)
        self._steps = np.array([key for key, _ in steps], np.int64)
        self._targets = np.array([n for _, n in steps], np.int64)
        self._unknown = min(scores.values()) - UNKNOWN_PENALTY
        self._known: dict[str, int] = {}

    def _step(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The vocabulary trie's states one character on; -1 where there is none."""
        keys = states * _CHARS + chars
        at = np.minimum(np.searchsorted(self._steps, keys), len(self._steps) - 1)
        return np.where(self._steps[at] == keys, self._targets[at], -1)

    def count_all(self, words: Sequence[str]) -> np.ndarray:
        """Token counts of distinct pre-tokens.

        They are put into a trie level by level. A node holds the best score and token count of its
        prefix, and the pieces still open there: where in the trie they began and how far in the
        vocabulary they are. All pre-tokens below share this work.
        """
        lengths = np.array([len(word) for word in words], np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        result = np.zeros(len(words), np.int64)
        active = np.flatnonzero(lengths > 0)
        node = np.zeros(len(active), np.int64)
        # Of the nodes of the level above, one by one, and of their open pieces, grouped by node.
        best, tokens = np.zeros(1), np.zeros(1, np.int64)
        open_count = np.zeros(1, np.int64)
        open_best, open_tokens, open_state = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth = 0
        while len(active):
            keys, node = np.unique(node * _CHARS + letters[starts[active] + depth], return_inverse=True)
            parent, char = keys // _CHARS, keys % _CHARS
            # A child inherits its parent's open pieces, and one more may begin at the parent.
            inherited, place = _repeat(open_count[parent])
            source = (np.cumsum(open_count) - open_count)[parent[inherited]] + place
            own = np.arange(len(keys))
            owner = np.concatenate([inherited, own])
            base = np.concatenate([open_best[source], best[parent]])
            base_tokens = np.concatenate([open_tokens[source], tokens[parent]])
            before = np.concatenate([open_state[source], np.zeros(len(keys), np.int64)])
            state = self._step(before, char[owner])
            alive = state >= 0
            single = state[len(inherited):]
            alone = (single < 0) | ~np.isfinite(self._score[np.maximum(single, 0)])
            size = 1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF)
            owner, base, base_tokens, state = owner[alive], base[alive], base_tokens[alive], state[alive]
            ended = np.isfinite(self._score[state])
            to = np.concatenate([owner[ended], own[alone]])
            score = np.concatenate([base[ended] + self._score[state[ended]], best[parent][alone] + self._unknown])
            count = np.concatenate([base_tokens[ended] + 1, tokens[parent][alone] + size[alone]])
            order = np.lexsort((count, -score, to))
            first = np.append(True, to[order][1:] != to[order][:-1])
            pick = order[first]
            new_best, new_tokens = np.full(len(keys), -np.inf), np.zeros(len(keys), np.int64)
            new_best[to[pick]], new_tokens[to[pick]] = score[pick], count[pick]
            grouped = np.argsort(owner, kind="stable")
            open_best, open_tokens, open_state = base[grouped], base_tokens[grouped], state[grouped]
            open_count = np.bincount(owner, minlength=len(keys))
            best, tokens = new_best, new_tokens
            depth += 1
            terminal = lengths[active] == depth
            result[active[terminal]] = tokens[node[terminal]]
            active, node = active[~terminal], node[~terminal]
        return result

    def count(self, texts: Sequence[str]) -> list[int]:
        """Tokens of each text."""
        split = [[WORD_START + word for word in _WORD.findall(text)] for text in texts]
        if len(self._known) > KNOWN_TOKENS:
            self._known = {}
        known = self._known
        new = list(dict.fromkeys(word for words in split for word in words if word not in known))
        known.update(zip(new, self.count_all(new).tolist()))
        return [sum([known[word] for word in words]) for words in split]


@cache
def unigram_counter(path: str) -> UnigramCounter:
    return UnigramCounter(unigram_scores(path))


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every whole text.

    A pre-token is a run of characters other than white space, with a mark before it. Nothing is
    shuffled; a task inserts the distinct pre-tokens of a few megabytes of text at a time. Null and
    empty texts have no tokens. Ids may be null or repeat. Other columns are not read.
    """
    path = tokenizer or tokenizer_path("piece_bpe_32k.model")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = unigram_counter(path)
        for batch in batches:
            counts: list[int] = []
            group: list[str] = []
            size = 0
            for text in batch["text"]:
                group.append(text.as_py() or "")
                size += len(group[-1])
                if size >= GROUP_CHARS:
                    counts += counter.count(group)
                    group, size = [], 0
            counts += counter.count(group)
            yield pa.record_batch([batch["doc_id"], pa.array(counts, pa.int64())], schema=_COUNTS)

    return documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).mapInArrow(measure, from_arrow_schema(_COUNTS))
