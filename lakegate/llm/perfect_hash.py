"""Minimal perfect hashing of 64-bit keys: levels of bit arrays, as in the published BBHash scheme."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from lakegate.llm.wordhash import mix

#: Bits per key still unplaced, at each level.
GAMMA = 2
_PER_WORD = 512


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64), 1000) % np.uint64(shards)).astype(np.int64)


class PerfectHash:
    """Maps n distinct keys onto 0 … n - 1; a foreign key gets some number or -1.

    At each level the keys left are hashed into a bit array; a key alone at its bit stays there,
    the others go on. A key's number is the number of set bits before its own.
    """

    def __init__(self, levels: Sequence[np.ndarray]) -> None:
        self.levels = list(levels)  # one bool array per level
        self.before, total = [], 0
        for bits in self.levels:
            blocks = np.add.reduceat(bits, np.arange(0, len(bits), _PER_WORD), dtype=np.int64)
            self.before.append(total + np.cumsum(blocks) - blocks)
            total += int(blocks.sum())
        self.size = total
        # Rank inside a block: bits set before each place, at most _PER_WORD.
        self.inside = []
        for bits in self.levels:
            running = np.cumsum(bits, dtype=np.int64) - bits
            starts = np.arange(0, len(bits), _PER_WORD)
            self.inside.append((running - np.repeat(running[starts], np.diff(starts, append=len(bits)))).astype(np.uint16))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left = np.unique(keys.astype(np.uint64))
        levels = []
        while len(left):
            size = GAMMA * len(left) + 1
            at = (mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (mix(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            where = at[hit]
            out[open_[hit]] = self.before[level][where // _PER_WORD] + self.inside[level][where]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out

    def packed(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return sizes.tobytes() + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def unpacked(cls, data: bytes) -> PerfectHash:
        count = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, count, 8).tolist()
        at, levels = 8 * (count + 1), []
        for size in sizes:
            n = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, n, at), count=size).astype(bool))
            at += n
        return cls(levels)


class KeyTable:
    """Sharded perfect hashes with the keys in hash order, so that a foreign key is told apart."""

    def __init__(self, packed: Sequence[bytes], keys: Sequence[np.ndarray]) -> None:
        self.parts = [PerfectHash.unpacked(data) for data in packed]
        self.first = np.cumsum([0, *(part.size for part in self.parts)])
        self.keys = np.concatenate([*keys, np.zeros(0, np.int64)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.first[-1])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that are not in the table."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self) or not len(keys):
            return out
        shards = shard_of(keys, len(self.parts))
        for shard in np.unique(shards):
            mine = np.flatnonzero(shards == shard)
            local = self.parts[shard](keys[mine])
            at = local + self.first[shard]
            known = (local >= 0) & (self.keys[np.minimum(at, len(self) - 1)] == keys[mine])
            out[mine[known]] = at[known]
        return out
