"""Points of the E8 lattice: the nearest one to a point, and those around it."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors: two ones of either sign, or halves with an even number of minuses."""
    found = []
    for i, j in combinations(range(8), 2):
        for signs in product((1, -1), repeat=2):
            vector = np.zeros(8)
            vector[[i, j]] = signs
            found.append(vector)
    halves = [np.array(x) / 2 for x in product((1, -1), repeat=8) if x.count(-1) % 2 == 0]
    return np.array(found + halves)


MINIMAL = _minimal_vectors()
# Points at a time, so that their distances stay in the cache.
_ROWS = 2048
_DOUBLED = (MINIMAL * 2).astype(np.int16)


def _nearest_even(points: np.ndarray) -> np.ndarray:
    """Nearest whole-numbered points with an even sum: round, and if the sum is odd, round the
    coordinate furthest from its whole number the other way."""
    whole = np.rint(points)
    error = points - whole
    odd = np.flatnonzero(whole.sum(1) % 2)
    worst = np.abs(error[odd]).argmax(1)
    whole[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
    return whole


def nearest(points: np.ndarray) -> np.ndarray:
    """Nearest lattice points: whole numbers with an even sum, or the same moved by one half."""
    whole = _nearest_even(points)
    moved = _nearest_even(points - 0.5) + 0.5
    closer = ((points - whole) ** 2).sum(1) <= ((points - moved) ** 2).sum(1)
    return np.where(closer[:, None], whole, moved)


def around(points: np.ndarray, probes: int) -> np.ndarray:
    """The nearest lattice point and the ``probes - 1`` nearest around it, in a byte each: the point's 8
    doubled coordinates, then the places of the others' differences from it in ``MINIMAL``."""
    return np.concatenate([_around(points[k : k + _ROWS], probes) for k in range(0, len(points), _ROWS)])


def _around(points: np.ndarray, probes: int) -> np.ndarray:
    home = nearest(points)
    doubled = (home * 2).clip(-128, 127).astype(np.int8).view(np.uint8)
    if probes == 1:
        return doubled
    # |rest - m|^2 without the part that is the same for all; all m are equally long. The last bits of
    # each number give way to its place, so that a plain partition, which is faster, returns places.
    far = (home - points) @ MINIMAL.T
    bits = far.view(np.int64)
    bits &= ~255
    bits |= np.arange(len(MINIMAL))
    far.partition(probes - 2, axis=1)
    order = bits[:, : probes - 1] & 255
    return np.concatenate([doubled, order.astype(np.uint8)], 1)


def names(found: np.ndarray) -> np.ndarray:
    """Names of the points that ``around`` found, the home first.

    A name holds the 8 doubled coordinates in a byte each, so different cells have different names
    as far as coordinates go from -64 to 63.
    """
    home = found[..., :8].view(np.int8)[..., None, :]
    others = home + _DOUBLED[found[..., 8:]]
    doubled = np.concatenate([np.broadcast_to(home, (*home.shape[:-2], 1, 8)), others], -2)
    return np.ascontiguousarray(doubled.clip(-128, 127).astype(np.int8)).view(np.int64)[..., 0]


def cells(points: np.ndarray, probes: int) -> np.ndarray:
    """Names of the nearest lattice point and of the ``probes - 1`` nearest around it."""
    return names(around(points, probes))
