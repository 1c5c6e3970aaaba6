"""Public tokenizer files. Their place is a parameter; nothing of them is kept here."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache

import numpy as np

SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_path(name: str) -> str:
    """Where the installed file of that name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


@cache
def byte_encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids under a byte-level BPE file of the tokenizers library.

    The faster tiktoken library merges with the same ranks, read from that file; strings of added
    tokens in a text become their ids, as in the library the file is for.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {letter: b for b, letter in byte_letters().items()}
    added = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {
        bytes(byte_of[letter] for letter in token): n
        for token, n in spec["model"]["vocab"].items()
        if token not in added
    }
    encoding = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: np.asarray(encoding.encode_to_numpy(text, allowed_special="all"))
