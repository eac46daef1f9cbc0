"""Minimal perfect hashes over sets of byte strings, with their keys.

A hash has levels of bits (Limasset et al., 2017): at each level the keys left
go to a place, those alone at theirs set its bit and are placed, the others go
on to the next level.  A key's slot is the rank of its bit.  Keys whose 64-bit
hashes collide are never alone; they are kept by name in the last slots.  The
keys are stored in slot order and compared, so a word that is no key never gets
a slot."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Places a key at every level.
ROOM = 2
LEVELS = 32
SEED = 42


def hashes(terms: pa.Array) -> np.ndarray:
    """XXH64 (seed 42) of binary terms, as Spark's xxhash64 of the same text."""
    own = terms.to_pylist()
    return np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in own), np.uint64, len(own))


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    return ((x ^ x >> np.uint64(29)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 of n different terms."""

    def __init__(self, terms: pa.Array):
        """terms: a binary array without nulls or repeats."""
        terms = terms.cast(pa.large_binary())
        left, h = np.arange(len(terms)), hashes(terms)
        self.bits: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        order, placed = [], 0
        for level in range(LEVELS):
            if not len(left):
                break
            size = -(-ROOM * len(left) // 64) * 64
            at = _place(h[left], level, size)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            count = np.bitwise_count(bits).astype(np.int64)
            self.bits.append(bits)
            self.ranks.append((placed + np.cumsum(count) - count).astype(np.uint32))
            good = alone[at]
            order.append(left[good][np.argsort(at[good])])
            placed += int(good.sum())
            left = left[~good]
        self.named = {terms[i].as_py(): placed + k for k, i in enumerate(left.tolist())}
        self.keys = terms.take(pa.array(np.concatenate([*order, left]).astype(np.int64)))

    def __len__(self) -> int:
        return len(self.keys)

    def nbytes(self) -> int:
        return self.keys.nbytes + sum(b.nbytes for b in (*self.bits, *self.ranks))

    def slots(self, terms: pa.Array, h: np.ndarray) -> np.ndarray:
        """The slot of every binary term (h: its hash), -1 if it is no key."""
        out = np.full(len(terms), -1, np.int64)
        left = np.arange(len(terms))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            at = _place(h[left], level, 64 * len(bits))
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)) == 1
            below = np.bitwise_count(word & (np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (ranks[at >> 6] + below)[hit]
            left = left[~hit]
        found = np.flatnonzero(out >= 0)
        same = pc.equal(self.keys.take(pa.array(out[found])), terms.take(pa.array(found)).cast(pa.large_binary()))
        out[found[~same.to_numpy(zero_copy_only=False)]] = -1
        if self.named:
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = self.named.get(terms[i].as_py(), -1)
        return out
