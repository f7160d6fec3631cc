"""Words of UTF-8 texts with 64-bit hashes, found by table lookups on whole byte arrays.

A word is a maximal run of bytes that a 256-entry table allows. Equal words have equal hashes once
A-Z are folded to a-z; callers that need certainty compare the bytes of the words they matched.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

HASH_PIECE = 1 << 18
STEP = np.uint64(0x9E3779B97F4A7C15)
SEED = 20240229


class Words(NamedTuple):
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # one past its last byte
    first: np.ndarray  # index of the first word of each text, and the number of words
    hashes: np.ndarray


def word_table(separators: list[tuple[int, int]]) -> np.ndarray:
    """True for the bytes of words, given the ranges of bytes that part them."""
    table = np.ones(256, bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(SEED).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


BYTE_VALUES = _byte_values()


def split(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Words of the texts that lie in ``data`` from each offset to the next; none crosses texts."""
    inside = table[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    begins[borders] = inside[borders]
    finishes[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + HASH_PIECE * 4, "right")))
        to = min(to, at + HASH_PIECE)
        hashes[at:to] = _hash(data, inside, starts[at:to], ends[at:to])
        at = to
    return Words(starts, ends, np.searchsorted(starts, offsets), hashes)


def _hash(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    span = slice(starts[0], ends[-1])
    lengths = ends - starts
    values = BYTE_VALUES[data[span][inside[span]]]
    begins = np.cumsum(lengths) - lengths
    powers = np.cumprod(np.full(int(lengths.max()), STEP), dtype=np.uint64)
    values *= powers[np.arange(len(values)) - np.repeat(begins, lengths)]
    return mix(np.add.reduceat(values, begins) + lengths.astype(np.uint64) * STEP)
