"""FM-index over a sequence of small integers: suffix order, wavelet-matrix ranks, sampled positions."""

from __future__ import annotations

import numpy as np

#: Text positions between two stored ones.
SAMPLE = 16


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of s in ascending order, by prefix doubling."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while n > 1:
        second = np.zeros(n, np.int64)
        if step < n:
            second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = fresh
        if rank[order[-1]] == n - 1:
            break
        step *= 2
    return order


class Bits:
    """A bit vector with counts of ones before every 64-bit word."""

    def __init__(self, bits: np.ndarray):
        words = -(-len(bits) // 64) + 1
        packed = np.zeros(words * 8, np.uint8)
        raw = np.packbits(bits, bitorder="little")
        packed[: len(raw)] = raw
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        inside = self.words[i >> 6] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[i >> 6] + np.bitwise_count(inside)


class Wavelet:
    """Ranks of symbols in a sequence, one bit vector a level, the highest bit first."""

    def __init__(self, s: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in reversed(range(self.depth)):
            bit = (s >> level & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(s) - bit.sum())))
            s = np.concatenate([s[~bit], s[bit]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first i elements."""
        start, end = np.zeros_like(i), i
        for k, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(end)
            start, end = np.where(one, zeros + a, start - a), np.where(one, zeros + b, end - b)
        return end - start

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The element at i and how often it occurs before i."""
        start, symbol = np.zeros_like(i), np.zeros_like(i)
        for bits, zeros in self.levels:
            one = bits.get(i)
            a, b = bits.ones(start), bits.ones(i)
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
            symbol = symbol << 1 | one
        return symbol, i - start


class FMIndex:
    """Of a sequence of symbols from 0 up; inside, they move up by one and 0 is the unique end."""

    def __init__(self, s: np.ndarray, symbols: int):
        s = np.append(s.astype(np.int64) + 1, 0)
        order = suffix_order(s)
        self.wavelet = Wavelet(s[order - 1], symbols + 1)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols + 1))])
        stored = order % SAMPLE == 0
        self.marked, self.stored = Bits(stored), order[stored]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each row of patterns (equally long), by backward search."""
        patterns = patterns + 1
        low, high = self.first[patterns[:, -1]], self.first[patterns[:, -1] + 1]
        alive = np.flatnonzero(low < high)
        for k in reversed(range(patterns.shape[1] - 1)):
            if not len(alive):
                break
            c = patterns[alive, k]
            a = self.first[c] + self.wavelet.rank(c, low[alive])
            b = self.first[c] + self.wavelet.rank(c, high[alive])
            low[alive], high[alive] = a, b
            alive = alive[a < b]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back to a stored one and add the steps."""
        out = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            here = self.marked.get(at)
            out[todo[here]] = self.stored[self.marked.ones(at[here])] + steps
            todo, at = todo[~here], at[~here]
            symbol, rank = self.wavelet.symbol_and_rank(at)
            at = self.first[symbol] + rank
            steps += 1
        return out
