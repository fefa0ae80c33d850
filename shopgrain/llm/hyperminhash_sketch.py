"""Word shingles and their HyperMinHash registers, as plain array functions.

A shingle hashes to 64 bits. The top eight name one of 256 buckets; of the others a
bucket keeps, for its smallest value, the count of leading zeros and the next ten
(mantissa) bits, together one 16-bit register. Equal registers of two sets stand for
equal minima, but for rare collisions that the estimate corrects.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

WORDS = 5
BUCKETS = 256
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
BANDS, ROWS = 64, 6
#: Registers of each band: 42 bands side by side, and 22 that step through all buckets.
IN_BAND = np.concatenate(
    [np.arange(42 * ROWS).reshape(42, ROWS), np.arange(22)[:, None] + 43 * np.arange(ROWS)[None, :]]
)

#: Constant of the expected number of accidental register collisions; a fixed value.
COLLISIONS = 0.169919487159739093975315012348630288992889
#: Pairs are given up before verification only this many standard deviations low.
MARGIN = 4.0


def shingles(text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct five-word shingles of a UTF-8 text.

    A-Z are lower-cased; a text of fewer words is one shingle, one without words none.
    bytes.lower and bytes.split know ASCII only, so their white space is [\\x20\\x09-\\x0D].
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= WORDS:
        return np.array([xxh3_64_intdigest(joined)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-WORDS]])
    pieces = zip(starts.tolist(), (ends[WORDS - 1 :] - 1).tolist(), strict=True)
    return np.unique(np.array([xxh3_64_intdigest(joined[a:b]) for a, b in pieces], dtype=np.uint64))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 256 registers of a sorted set; the smallest value of a bucket comes first."""
    out = np.full(BUCKETS, EMPTY)
    if len(hashes):
        bucket = (hashes >> np.uint64(56)).astype(np.int64)
        first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        value = hashes[first] << np.uint64(8)
        # Exact leading zeros: the top 32 set bits fit a double without rounding up.
        high = (value >> np.uint64(32)).astype(np.float64)
        low = (value & np.uint64(0xFFFFFFFF)).astype(np.float64)
        zeros = np.where(high > 0, 32 - np.frexp(high)[1], 64 - np.frexp(low)[1])
        zeros = np.minimum(zeros, 55).astype(np.uint64)
        rest = (value << zeros) << np.uint64(1)
        out[bucket[first]] = (zeros << np.uint64(MANTISSA) | rest >> np.uint64(64 - MANTISSA)).astype(np.uint16)
    return out


def band_keys(sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, band, key) of each band with a register that is not empty; sketches: rows of 256."""
    bands = sketches[:, IN_BAND]
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            key = (key ^ bands[:, :, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    row, band = np.nonzero((bands != EMPTY).any(axis=2))
    return row, band, key[row, band].view(np.int64)


def small(sketches: np.ndarray) -> np.ndarray:
    """Registers cut to one byte, 255 for empty ones: enough to estimate with."""
    low = (sketches & 0xFF).astype(np.uint8)
    return np.where(sketches == EMPTY, 255, np.minimum(low, 254)).astype(np.uint8)


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of small sketches (row by row) can be linked.

    The minima of the used buckets are a sample, without replacement, of the union; the
    estimate is their equal share, less the collisions expected by chance, and its
    deviation that of such a sample at the threshold itself.
    """
    least = percent / 100
    n_a, n_b = n_a.astype(np.float64), n_b.astype(np.float64)
    used = np.maximum(((a != 255) | (b != 255)).sum(axis=-1), 1).astype(np.float64)
    equal = ((a == b) & (a != 255)).sum(axis=-1)
    alike = 4 * n_a * n_b / (n_a + n_b) ** 2
    chance = COLLISIONS * 2.0**-MANTISSA * alike + 1 / 256
    estimate = (equal / used - chance) / (1 - chance)
    union = (n_a + n_b) / (1 + least)
    left_out = np.maximum(union - used, 0) / np.maximum(union - 1, 1)
    deviation = np.sqrt(least * (1 - least) / used * left_out) + 0.1 / used
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return sizes & (estimate >= least - MARGIN * deviation)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
