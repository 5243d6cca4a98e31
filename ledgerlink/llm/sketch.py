"""Fast similarity sketches of sets of 64-bit numbers, on numpy arrays.

A sketch has ``size`` coordinates.  Elements are thrown into the bins in rounds: in
each of the first ``size`` rounds every element goes to one bin chosen by that
round's hash, and a bin keeps the smallest value of the first round that reaches it.
Bins that are still empty then get a round of their own, in which all elements
compete, so every coordinate is filled and two sets agree in a coordinate with a
probability equal to their Jaccard similarity, concentrated as for independent
coordinates.
"""

from __future__ import annotations

import numpy as np

_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_GOLDEN = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)
_EMPTY = np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Sketcher:
    """Sketches of ``bands * rows`` coordinates, given out as one hash per band."""

    def __init__(self, bands: int, rows: int, seed: int = 1) -> None:
        self.bands, self.rows, self.size = bands, rows, bands * rows
        self.seeds = mix(
            np.arange(1, 2 * self.size + 1, dtype=np.uint64) * np.uint64(_GOLDEN)
            + np.uint64(seed)
        )
        self.odd = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)

    def coordinates(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of coordinates for each set of distinct elements; none may be empty."""
        t = self.size
        out = np.full(len(sets) * t, _EMPTY, dtype=np.uint64)
        if not sets:
            return out.reshape(0, t)
        elements = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        for turn in range(2 * t):
            h = mix(elements ^ self.seeds[turn])
            if turn < t:
                bins = (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64)
            else:
                bins = turn - t
            # The round stands in the high bits, so a filled bin keeps its value.
            np.minimum.at(out, owner * t + bins, (h & _LOW) | np.uint64(turn << 32))
            open_sets = (out.reshape(-1, t) == _EMPTY).any(axis=1)
            if not open_sets.any():
                break
            left = open_sets[owner]
            elements, owner = elements[left], owner[left]
        return out.reshape(-1, t)

    def band_hashes(self, sets: list[np.ndarray]) -> np.ndarray:
        c = mix(self.coordinates(sets)).reshape(len(sets), self.bands, self.rows)
        s = (c * self.odd).sum(axis=2, dtype=np.uint64)
        s += mix(np.arange(1, self.bands + 1, dtype=np.uint64))
        return mix(s).view(np.int64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two sorted arrays of distinct elements share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
