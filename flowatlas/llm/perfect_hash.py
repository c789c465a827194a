"""A minimal perfect hash: each of n known keys to a place of its own in 0 .. n-1.

Level by level every key asks for one bit; keys that are alone at theirs get it, the others go
on to the next level. A key's place is the number of bits set before its own, read from a
running count for each 512 bits and a count within them, so a lookup takes a few steps
whatever n. Keys are told apart by 128 bits of hash; equal keys are an error.
"""

import numpy as np
import xxhash

GAMMA = 2.0
LEVELS = 200
WORDS = 8  # 64-bit words for each running count


def hashes(keys: list[str]) -> np.ndarray:
    """Two unsigned numbers for each key."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(k.encode()) for k in keys), ">u8").astype(np.uint64).reshape(-1, 2)


def fingerprints(pairs: np.ndarray) -> np.ndarray:
    """32 bits of each key, mixed apart from those that place it."""
    return (((pairs[:, 0] ^ (pairs[:, 1] >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def _asked(pairs: np.ndarray, level: int, size: int) -> np.ndarray:
    value = pairs[:, 0] + np.uint64(level) * (pairs[:, 1] | np.uint64(1))
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((value ^ (value >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """`sizes`: bits of each level; `bits`: all levels' bits as 64-bit words; `counts`: ones before each block."""

    def __init__(self, sizes: list[int], bits: np.ndarray, counts: np.ndarray):
        self.sizes, self.bits, self.counts = sizes, bits, counts

    @classmethod
    def build(cls, pairs: np.ndarray) -> "PerfectHash":
        sizes, levels, left = [], [], pairs
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("equal keys have no perfect hash")
            size = -(-int(GAMMA * len(left)) // 64) * 64 or 64
            at = _asked(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        bits = np.concatenate(levels).view(np.uint64) if levels else np.zeros(0, np.uint64)
        ones = np.bitwise_count(np.pad(bits, (0, -len(bits) % WORDS))).reshape(-1, WORDS).sum(axis=1, dtype=np.int64)
        return cls(sizes, bits, (np.cumsum(ones) - ones).astype(np.uint32))

    def places(self, pairs: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where no level has it; an unknown key can get any."""
        out = np.full(len(pairs), -1, np.int64)
        rest, base = np.arange(len(pairs)), 0
        for level, size in enumerate(self.sizes):
            if not len(rest):
                break
            at = base + _asked(pairs[rest], level, size)
            set_ = (self.bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            out[rest[set_]] = self._rank(at[set_])
            rest = rest[~set_]
            base += size
        return out

    def _rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        block = word // WORDS
        rank = self.counts[block].astype(np.int64)
        for k in range(WORDS):  # words of the block before the key's own
            other = block * WORDS + k
            before = other < word
            rank[before] += np.bitwise_count(self.bits[other[before]])
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return rank + np.bitwise_count(self.bits[word] & below)
