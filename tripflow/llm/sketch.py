"""Shingle sets and fast similarity sketches.

A sketch has `t` coordinates. In round i every element of the set is hashed to one coordinate and
a value; a coordinate keeps the smallest (round, value) that reaches it. Rounds t .. 2t-1 send all
elements to coordinate i - t, so every coordinate fills whatever the set's size, and two sketches
agree in a share of coordinates that concentrates around the Jaccard similarity. Large sets fill
all coordinates in the first rounds: the work is about |set| + t log t.
"""

from __future__ import annotations

import numpy as np

from tripflow.llm.text import WORDS, Words, mix

SHINGLE = 5


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of each row's different shingles; a shorter text is one shingle."""
    prefix = WORDS.prefix(words.hashes())
    windows = WORDS.windows(prefix, size)
    whole = WORDS.ranges(prefix, words.rows[:-1], words.rows[1:])
    out = []
    for i, (a, b) in enumerate(zip(words.rows[:-1].tolist(), words.rows[1:].tolist())):
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        else:
            out.append(whole[i : i + 1] if b > a else whole[:0])
    return out


class Sketcher:
    def __init__(self, coordinates: int):
        self.t = coordinates
        with np.errstate(over="ignore"):
            self.seeds = mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64))

    def _fill(self, out: np.ndarray, elements: np.ndarray, first: int, last: int) -> None:
        hashes = mix((elements[None, :] ^ self.seeds[first:last, None]).ravel())
        places = ((hashes >> np.uint64(32)) * np.uint64(self.t)) >> np.uint64(32)
        rounds = np.repeat(np.arange(first, last, dtype=np.uint64), len(elements))
        values = (rounds << np.uint64(40)) | (hashes & np.uint64((1 << 40) - 1))
        order = np.argsort(values)[::-1]
        best = np.full(self.t, np.iinfo(np.uint64).max, dtype=np.uint64)
        best[places[order]] = values[order]
        np.minimum(out, best, out=out)

    def sketch(self, elements: np.ndarray) -> np.ndarray:
        """Coordinates of a set that is not empty."""
        t = self.t
        empty = np.iinfo(np.uint64).max
        out = np.full(t, empty, dtype=np.uint64)
        first = 0
        while first < t and (out == empty).any():
            last = min(t, first + max(1, (6 * t) // len(elements)))
            self._fill(out, elements, first, last)
            first = last
        left = np.flatnonzero(out == empty)
        for i in left.tolist():
            low = mix(elements ^ self.seeds[t + i]).min()
            out[i] = (np.uint64(t + i) << np.uint64(40)) | (low & np.uint64((1 << 40) - 1))
        return out


def bands(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of `rows` coordinates, different between bands."""
    groups = sketch.reshape(-1, rows)
    turns = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    number = np.arange(len(groups), dtype=np.uint64) << np.uint64(7)
    return mix((mix(groups) * turns).sum(axis=1, dtype=np.uint64) ^ mix(number + np.uint64(1)))
