"""Which trigrams a text must hold for a regular expression to match it.

A small walk over Python's parse of the pattern: literals and small classes form exact strings,
anything else ends them. The result is a conjunction of alternatives of trigram sets.
"""

from __future__ import annotations

import re
from itertools import product
from re import _constants as op
from re import _parser as parser

# Exact strings kept side by side; more than this end the run.
MOST_STRINGS = 64

Clause = frozenset[frozenset[str]]


def clauses(pattern: str) -> list[Clause]:
    """Conditions that all hold for a text with a match: of each, one set of trigrams is in it.

    Trigrams are of the text in lower case. An empty list means the pattern has no mandatory
    trigram, so that every text must be looked at.
    """
    found: list[Clause] = []
    tail = _walk(parser.parse(pattern, re.ASCII), {""}, found)
    _close(tail, found)
    return list(dict.fromkeys(found))


def branches(pattern: str) -> list[frozenset[str]]:
    """The same as alternatives, each a set of trigrams; empty if there is no mandatory trigram."""
    whole = [frozenset().union(*picked) for picked in product(*clauses(pattern))]
    least = [b for b in set(whole) if not any(other < b for other in whole)]
    return sorted(least, key=sorted) if clauses(pattern) else []


def _close(strings: set[str], found: list[Clause]) -> None:
    """Add what the exact strings ask for; a short one among them asks for nothing."""
    if all(len(s) >= 3 for s in strings):
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
        found.append(frozenset(s for s in sets if not any(other < s for other in sets)))


def _small(items) -> set[str] | None:
    """Characters of a class, if few."""
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 8:
            chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return chars if len(chars) <= 8 else None


def _walk(sequence, strings: set[str], found: list[Clause]) -> set[str]:
    """The exact strings that end here, each beginning where the last run was broken."""
    for kind, value in sequence:
        options: set[str] | None = None
        if kind is op.LITERAL:
            options = {chr(value).lower()}
        elif kind is op.IN:
            options = _small(value)
        elif kind is op.SUBPATTERN:
            options = _exact(value[3])
        elif kind is op.BRANCH:
            options = _exact([(kind, value)])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            inner_strings = _exact(inner)
            if inner_strings is not None and high == 1:
                options = inner_strings | {""}
            elif inner_strings is not None and low == high and low <= 4:
                options = {"".join(p) for p in product(inner_strings, repeat=low)}
            elif inner_strings is not None and low >= 1:
                # The first round is certain; what follows is not.
                strings = {s + t for s in strings for t in inner_strings}
                if len(strings) > MOST_STRINGS:
                    strings = {""}
        if options is not None and len(strings) * len(options) <= MOST_STRINGS:
            strings = {s + t for s in strings for t in options}
        else:
            _close(strings, found)
            strings = options if options is not None and len(options) <= MOST_STRINGS else {""}
            if kind is op.SUBPATTERN and options is None:
                strings = _walk(value[3], {""}, found)
    return strings


def _exact(sequence) -> set[str] | None:
    """All strings the sequence can match in lower case, if they are few."""
    strings = {""}
    for kind, value in sequence:
        if kind is op.LITERAL:
            options = {chr(value).lower()}
        elif kind is op.IN:
            options = _small(value)
        elif kind is op.SUBPATTERN:
            options = _exact(value[3])
        elif kind is op.BRANCH:
            each = [_exact(part) for part in value[1]]
            options = None if None in each else set().union(*each)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] == 1:
            inner = _exact(value[2])
            options = None if inner is None else inner | ({""} if value[0] == 0 else set())
        else:
            options = None
        if options is None or len(strings) * len(options) > MOST_STRINGS:
            return None
        strings = {s + t for s in strings for t in options}
    return strings
