"""Words of many texts as arrays of 64-bit hashes, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: White space of the word pattern [^\x20\x09-\x0D]+.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, nothing else.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    return _mix(x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64))


_BYTES = mix(np.arange(256, dtype=np.uint64), 11) | np.uint64(1)
_BASE = 0xD1342543DE82EF95
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        factors = np.full(max(n, 2 * len(_POWERS)), _BASE, np.uint64)
        factors[0] = 1
        _POWERS = np.multiply.accumulate(factors)
    return _POWERS


def word_hashes(texts: Sequence[bytes]) -> list[np.ndarray]:
    """One array of word hashes per text.

    A word is hashed as a polynomial over random values of its bytes modulo 2^64, mixed at the
    end; its position plays no part.
    """
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    solid = ~_BLANK[data]
    edges = np.flatnonzero(np.diff(solid, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    lengths = ends - starts
    at = np.arange(len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))[: len(data)] if starts[0] == 0 else None
    if at is None:
        lead = int(starts[0])
        at = np.concatenate([np.zeros(lead, np.int64), np.arange(lead, len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))])
    at[~solid] = 0
    powers = _powers(int(lengths.max()) + 1)
    terms = _BYTES[data] * powers[at]
    terms[~solid] = 0
    sums = np.add.reduceat(terms, starts)
    hashes = mix(sums, 1)
    stops = np.cumsum([len(t) + 1 for t in texts])
    return np.split(hashes, np.searchsorted(starts, stops[:-1])) if len(texts) > 1 else [hashes]


def rolling(words: np.ndarray, length: int, multiplier: int) -> np.ndarray:
    """Hash of each run of ``length`` words, by doubling: a few array operations per bit."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    total, out, done = len(words) - length + 1, None, 0
    power, width, block = multiplier, 1, words
    while True:
        if length & width:
            # Runs of ``done`` words already hashed are followed by a block of ``width`` words.
            part = block[done : done + total]
            out = part.copy() if out is None else out * np.uint64(power) + part
            done += width
        if done == length:
            return out
        block = block[: len(block) - width] * np.uint64(power) + block[width:]
        power = power * power % 2**64
        width *= 2
