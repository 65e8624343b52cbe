"""Cuckoo filter over 128-bit digests: insert, delete, vectorised lookup."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_KICKS = 400
_MIX = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def split_digests(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket hash, fingerprint source) of 16-byte digests as two uint64 arrays."""
    both = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


class CuckooFilter:
    """Partial-key cuckoo hashing, 16-bit fingerprints, 4 slots a bucket.

    A key may be inserted once; ``delete`` removes one matching fingerprint,
    which is safe for keys that were inserted. Kicks follow a fixed rotation,
    so equal histories give equal filters. ``insert`` answers False when the
    table is full: the owner then rebuilds a larger one from its exact table.
    """

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.85)))))
            table = np.zeros((buckets, SLOTS), np.uint16)
        self.table = table
        self.mask = len(table) - 1

    @classmethod
    def from_bytes(cls, blob: bytes) -> "CuckooFilter":
        return cls(0, np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _place(self, digest: bytes) -> tuple[int, int]:
        fp = (int.from_bytes(digest[8:], "little") & 0xFFFF) or 1
        return fp, int.from_bytes(digest[:8], "little") & self.mask

    def _other(self, bucket: int, fp: int) -> int:
        return (bucket ^ (((fp * _MIX) & _MASK) >> 32)) & self.mask

    def insert(self, digest: bytes) -> bool:
        fp, bucket = self._place(digest)
        for b in (bucket, self._other(bucket, fp)):
            free = np.flatnonzero(self.table[b] == 0)
            if len(free):
                self.table[b, free[0]] = fp
                return True
        b = bucket
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            fp, self.table[b, slot] = int(self.table[b, slot]), fp
            b = self._other(b, fp)
            free = np.flatnonzero(self.table[b] == 0)
            if len(free):
                self.table[b, free[0]] = fp
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        fp, bucket = self._place(digest)
        for b in (bucket, self._other(bucket, fp)):
            at = np.flatnonzero(self.table[b] == fp)
            if len(at):
                self.table[b, at[0]] = 0
                return True
        return False

    def contains(self, digests: list[bytes]) -> np.ndarray:
        if not digests:
            return np.zeros(0, bool)
        low, high = split_digests(digests)
        fp = (high & np.uint64(0xFFFF)).astype(np.uint16)
        fp[fp == 0] = 1
        b1 = low & np.uint64(self.mask)
        b2 = (b1 ^ ((fp.astype(np.uint64) * np.uint64(_MIX)) >> np.uint64(32))) \
            & np.uint64(self.mask)
        return ((self.table[b1] == fp[:, None]) | (self.table[b2] == fp[:, None])).any(axis=1)


def built(digests: list[bytes]) -> CuckooFilter:
    """A filter of all digests, doubled until everything fits."""
    capacity = len(digests)
    while True:
        f = CuckooFilter(capacity)
        if all(f.insert(d) for d in digests):
            return f
        capacity = 2 * max(capacity, SLOTS * len(f.table))
