"""Elias-Fano sequences and a two-level n-gram trie over memory-mapped arrays, with vectorised queries."""

from __future__ import annotations

import os

import numpy as np

_CHUNK = 1 << 15


class EliasFano:
    """A monotone sequence of unsigned numbers: packed low bits, and high bits in unary. Both stay in mapped files.

    In memory is only a directory: how many ones stand before each 64 bits of the unary part.
    """

    def __init__(self, path: str):
        n, low, buckets = (int(x) for x in np.fromfile(f"{path}.head", np.uint64))
        self.n, self.low, self.buckets = n, low, buckets
        self.lows = np.memmap(f"{path}.low", np.uint8, "r")
        self.unary = np.memmap(f"{path}.high", np.uint8, "r").reshape(-1, 8)
        self.ones = np.zeros(len(self.unary) + 1, np.uint32)
        for at in range(0, len(self.unary), _CHUNK):
            part = np.bitwise_count(self.unary[at : at + _CHUNK]).sum(axis=1, dtype=np.uint32)
            self.ones[at + 1 : at + 1 + len(part)] = self.ones[at] + np.cumsum(part, dtype=np.uint32)

    def _select(self, rank: np.ndarray, one: bool) -> np.ndarray:
        """Where in the unary part the one (or zero) with this number is, counted from 0."""
        before = self.ones if one else self._zeros()
        out = np.empty(len(rank), np.int64)
        for at in range(0, len(rank), _CHUNK):
            r = rank[at : at + _CHUNK].astype(np.int64)
            block = np.searchsorted(before, r, "right") - 1
            bits = np.unpackbits(self.unary[block], axis=1)
            seen = np.cumsum(bits if one else 1 - bits, axis=1, dtype=np.uint8)
            out[at : at + _CHUNK] = block * 64 + (seen == (r - before[block] + 1)[:, None]).argmax(axis=1)
        return out

    def _zeros(self) -> np.ndarray:
        return np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    def first(self, bucket: np.ndarray) -> np.ndarray:
        """The number of the first element whose high bits are at least the bucket."""
        out = np.zeros(len(bucket), np.int64)
        later = bucket > 0
        out[later] = self._select(bucket[later] - 1, False) - (bucket[later] - 1)
        return out

    @staticmethod
    def write(path: str, values: np.ndarray) -> None:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low = min(56, max(0, (top // max(1, n)).bit_length() - 1))
        buckets = (top >> low) + 1
        np.array([n, low, buckets], np.uint64).tofile(f"{path}.head")
        with open(f"{path}.low", "wb") as f:
            for at in range(0, n, _CHUNK):  # a multiple of eight numbers: chunks end at whole bytes
                bits = np.unpackbits(values[at : at + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - low :]
                f.write(np.packbits(bits.ravel()).tobytes())
            f.write(bytes(16))
        unary = np.zeros(-(-(n + buckets) // 64) * 64, np.uint8)
        unary[(values >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
        np.packbits(unary).tofile(f"{path}.high")

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        words = np.ascontiguousarray(self.lows[(bit >> 3)[:, None] + np.arange(8)]).view(">u8").ravel().astype(np.uint64)
        return words << (bit & 7).astype(np.uint64) >> np.uint64(64 - self.low)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return (self._select(i, True) - i).astype(np.uint64) << np.uint64(self.low) | self.low_bits(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element that is at least x (n if none): select the bucket, then halve within it."""
        x = x.astype(np.uint64)
        high = np.minimum(x >> np.uint64(self.low), np.uint64(self.buckets)).astype(np.int64)
        inside = high < self.buckets
        lo = self.first(high)
        hi = np.where(inside, self.first(np.minimum(high + 1, self.buckets)), lo)
        wanted = x & np.uint64((1 << self.low) - 1)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = lo[open_] + hi[open_] >> 1
            less = self.low_bits(mid) < wanted[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        return lo


#: Log10 probabilities are kept in 16 bits: zero to -SPAN in equal steps; the last code is "not in the trie".
SPAN = 24.0
ABSENT = 65535


def quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.minimum(np.round(-np.log10(p) * (ABSENT - 1) / SPAN), ABSENT - 1).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    return np.where(code == ABSENT, 0.0, 10.0 ** (code.astype(float) * -SPAN / (ABSENT - 1)))


CONTEXT_BITS = 60
SUCCESSOR_BITS = 40


class NgramTrie:
    """Level 1: contexts. Pointers: where each context's successors begin. Level 2: successors, relative to their context."""

    def __init__(self, folder: str):
        self.contexts, self.pointers, self.successors = (EliasFano(os.path.join(folder, x)) for x in ("contexts", "pointers", "successors"))
        self.codes = np.memmap(os.path.join(folder, "codes"), np.uint16, "r")

    @staticmethod
    def write(folder: str, context: np.ndarray, successor: np.ndarray, p: np.ndarray) -> None:
        """context (CONTEXT_BITS) and successor (SUCCESSOR_BITS) in lexicographic order, without repetition; not empty."""
        new = np.r_[True, context[1:] != context[:-1]]
        rank = np.cumsum(new) - 1
        EliasFano.write(os.path.join(folder, "contexts"), context[new])
        EliasFano.write(os.path.join(folder, "pointers"), np.r_[np.flatnonzero(new), len(context)])
        EliasFano.write(os.path.join(folder, "successors"), rank.astype(np.uint64) << np.uint64(SUCCESSOR_BITS) | successor)
        quantised(p).tofile(os.path.join(folder, "codes"))

    def lookup(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The code of each n-gram, ABSENT where the trie has none."""
        out = np.full(len(context), ABSENT, np.uint16)
        rank = self.contexts.successor(context)
        there = np.flatnonzero(rank < self.contexts.n)
        there = there[self.contexts[rank[there]] == context[there]]
        rank = rank[there]
        relative = rank.astype(np.uint64) << np.uint64(SUCCESSOR_BITS) | successor[there]
        at = self.successors.successor(relative)
        # the search must stay between the context's pointers
        ok = (at >= self.pointers[rank].astype(np.int64)) & (at < self.pointers[rank + 1].astype(np.int64))
        at, there, relative = at[ok], there[ok], relative[ok]
        same = self.successors[at] == relative
        out[there[same]] = self.codes[at[same]]
        return out
