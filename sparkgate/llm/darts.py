"""DartMinHash: signatures of weighted sets whose agreement estimates weighted Jaccard similarity.

Every element owns a strip of the plane, as wide as its weight and open upwards. Darts fall on the
strip as a Poisson process that depends on the element alone: two sets that hold the element see
the same darts, as far as their weights reach. A dart's height is its rank, and it belongs to one
of the signature's coordinates; the lowest dart of each coordinate is the signature. A set of
weight w needs about k log k darts, whatever its number of elements: those below k log k / w.
"""

from __future__ import annotations

import math

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers above 0, 1 at most."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)


def _strips(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strips' bands [0, 1), [1, 2), [2, 4), ... up to each weight: element, band, lower edge."""
    bands = np.ones(len(weights), np.int64)
    wide = weights > 1
    bands[wide] += np.ceil(np.log2(weights[wide])).astype(np.int64)
    element = np.repeat(np.arange(len(weights)), bands)
    band = np.arange(len(element)) - np.repeat(np.cumsum(bands) - bands, bands)
    return element, band, np.where(band == 0, 0.0, 2.0 ** (band - 1))


def signatures(elements: np.ndarray, owners: np.ndarray, weights: np.ndarray, n_sets: int, k: int) -> np.ndarray:
    """n_sets x k darts (hashes) of weighted sets.

    elements are 64-bit hashes, owners the set each belongs to, weights above 0. No element may
    occur twice in a set, and each set has an element. Sets in which a coordinate stayed empty are
    thrown at again, twice as high, until none is.
    """
    lowest = np.full(n_sets * k, np.inf)
    darts = np.zeros(n_sets * k, np.uint64)
    total = np.bincount(owners, weights, minlength=n_sets)
    height = k * (math.log(k) + 3) / np.maximum(total, 1e-300)
    element, band, edge = _strips(weights)
    seed = mix(elements[element] ^ (mix(band.astype(np.uint64) + np.uint64(1))))
    width = np.where(band == 0, 1.0, edge)
    open_sets = np.bincount(owners, minlength=n_sets) > 0
    while open_sets.any():
        active = np.flatnonzero(open_sets[owners[element]])
        rank = np.zeros(len(active))
        throw = 0
        hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(active):
            throw += 1
            dart = mix(seed[active] + np.uint64(throw * int(_GOLDEN) % (1 << 64)))
            rank = rank - np.log(_unit(dart)) / width[active]
            below = rank < height[owners[element[active]]]
            active, rank, dart = active[below], rank[below], dart[below]
            own = element[active]
            inside = edge[active] + width[active] * _unit(mix(dart ^ _GOLDEN)) <= weights[own]
            place = owners[own] * k + (mix(dart + _GOLDEN) % np.uint64(k)).astype(np.int64)
            hits.append((place[inside], rank[inside], dart[inside]))
        place, height_of, dart = (np.concatenate(parts) for parts in zip(*hits))
        np.minimum.at(lowest, place, height_of)
        first = lowest[place] == height_of
        darts[place[first]] = dart[first]
        filled = np.isfinite(lowest).reshape(n_sets, k).all(axis=1)
        open_sets &= ~filled
        height = np.where(open_sets, height * 2, height)
    return darts.reshape(n_sets, k)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """Hashes of each signature's bands of so many coordinates, the band's number mixed in."""
    n, k = signature.shape
    parts = signature[:, : k // rows * rows].reshape(n, k // rows, rows)
    code = np.tile(mix(np.arange(k // rows, dtype=np.uint64) + np.uint64(1)), (n, 1))
    for row in range(rows):
        code = mix(code * _GOLDEN + parts[:, :, row])
    return code
