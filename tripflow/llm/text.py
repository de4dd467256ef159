"""Words and rolling hashes over whole Arrow string columns.

A column's texts lie one after the other in a single UTF-8 buffer, so word borders and hashes of
all of them come from a few numpy passes instead of a loop over words. Arithmetic is modulo 2**64.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A word is a maximal run of [^\x20\x09-\x0D]. Fixed values of the contract.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text worked on at once; one text may exceed it.
CHUNK_BYTES = 2_000_000

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[128:] = _IS_LETTER[48:58] = _IS_LETTER[65:91] = _IS_LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits under which close values end far apart (SplitMix64)."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Roller:
    """Hashes of any range of a sequence of numbers, from prefix sums of value * base**place."""

    def __init__(self, seed: int):
        self.seed = seed
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 62, 1 << 63)) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)
        self.letters = rng.integers(0, 1 << 64, 256, dtype=np.uint64)

    def __reduce__(self):
        # Tables of powers grow where they are needed; they do not travel with tasks.
        return _roller, (self.seed,)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers), 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("powers", self.base), ("inverses", self.inverse)):
                    steps = np.full(size, base & ((1 << 64) - 1), dtype=np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums, with a leading 0."""
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(prefix))
        return mix((prefix[ends] - prefix[starts]) * self.inverses[starts])

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all ranges of `width` values; empty where there are too few."""
        n = len(prefix) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        self._grow(n)
        return mix((prefix[width:] - prefix[:n]) * self.inverses[:n])


@functools.cache
def _roller(seed: int) -> Roller:
    return Roller(seed)


BYTES = _roller(11)
WORDS = _roller(23)
#: Second, independent hashes.
BYTES2 = _roller(37)


def texts_of(
    column: pa.Array | pa.ChunkedArray, most: int = CHUNK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a string column: number of the first row, bytes, and offsets of its rows.

    A missing text counts as empty. A piece has up to `most` bytes, or one text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if len(column) == 0:
        return
    if not pa.types.is_large_binary(column.type):
        if column.null_count:
            column = column.fill_null("")
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """Words of a piece: byte range of each, and the range of words of each row."""

    def __init__(
        self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, letters: bool = False
    ):
        """`letters`: words are runs of ASCII letters, digits and bytes above 127 instead."""
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        solid = _IS_LETTER[data] if letters else ~_IS_SPACE[data]
        self._solid = solid
        n = len(solid)
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = solid[:-1]
            after[-1] = False
            after[:-1] = solid[1:]
        self.starts = np.flatnonzero(solid & (~before | edge[:n]))
        self.ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.rows = np.searchsorted(self.starts, offsets)

    def hashes(self, roller: Roller = BYTES) -> np.ndarray:
        prefix = roller.prefix(roller.letters[self.data])
        return roller.ranges(prefix, self.starts, self.ends)

    def digests(self) -> list[bytes]:
        """128-bit digest of each row's words, whatever stands between them."""
        starts = self.starts[1:]
        between = np.ones(len(starts), dtype=bool)
        between[self.rows[(self.rows > 0) & (self.rows < len(self.starts))] - 1] = False
        # One space before every word but a row's first.
        gaps = starts[between] - 1
        kept = self._solid.copy()
        kept[gaps] = True
        plain = self.data.copy()
        plain[gaps] = 0x20
        ends = np.concatenate([[0], np.cumsum(kept)])[self.offsets].tolist()
        plain = plain[kept]
        return [
            hashlib.blake2b(plain[a:b], digest_size=16).digest() for a, b in zip(ends, ends[1:])
        ]

    def joined(self, keep: np.ndarray, first: int, last: int) -> bytes:
        """The kept words from `first` up to `last`, joined by one space."""
        raw = self.data.tobytes()
        chosen = np.flatnonzero(keep) + first
        return b" ".join(
            [raw[a:b] for a, b in zip(self.starts[chosen].tolist(), self.ends[chosen].tolist())]
        )


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's LONG."""
    return x.view(np.int64)


def unsigned(x) -> np.ndarray:
    return np.asarray(x, dtype=np.int64).view(np.uint64)


_PLACE_BITS = np.uint64(31)


def lowest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the lowest value (the first of equal ones) in each run of `width` values.

    Values count by their upper 33 bits, so two runs of the same values choose the same place. The
    lowest of a run is the lower of those of two shorter runs that cover it, whose lengths double.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    low = values >> _PLACE_BITS
    low <<= _PLACE_BITS
    low |= np.arange(len(values), dtype=np.uint64)
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        low = np.minimum(low[:-step], low[step:])
        covered += step
    low &= np.uint64((1 << 31) - 1)
    return low.astype(np.int64)
