"""Sorted hash arrays: 64-bit hashes in ascending order with an index on their leading bits."""

from __future__ import annotations

import numpy as np

from .text import U


class SortedHashes:
    """Positions of hashes in a sorted array; their leading bits (uniform by construction) say where to look."""

    def __init__(self, hashes: np.ndarray):
        h = np.asarray(hashes, np.uint64)
        self.order = np.argsort(h, kind="stable")
        self.n = len(h)
        self.shift = U(64 - max(1, int(max(self.n, 1) - 1).bit_length()))
        self.h = np.append(h[self.order], U(0xFFFFFFFFFFFFFFFF))
        edges = np.arange((1 << (64 - int(self.shift))), dtype=np.uint64) << self.shift
        self.start = np.searchsorted(self.h[:-1], edges).astype(np.int32 if self.n < 1 << 31 else np.int64)

    def find(self, q: np.ndarray) -> np.ndarray:
        """Place of each hash in the sorted array, or -1."""
        at = self.start[(q >> self.shift).astype(np.int64)].astype(np.int64)
        live = np.flatnonzero(self.h[at] < q)
        while len(live):
            at[live] += 1
            live = live[self.h[at[live]] < q[live]]
        return np.where((self.h[at] == q) & (at < self.n), at, -1)
