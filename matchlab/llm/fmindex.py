"""A compressed full-text index over word numbers: Burrows-Wheeler transform in a wavelet matrix, backward search for
many patterns at once, and matching statistics cut at a threshold."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank: 64-bit words and the number of ones before each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.r_[bits.astype(np.uint8), np.zeros(-n % 64 + 64, np.uint8)], bitorder="little")
        self.words = packed.view("<u8").astype(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        w = i >> 6
        low = self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[w] + np.bitwise_count(low).astype(np.int64)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, self.zeros = [], []
        s = symbols
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bit = (s >> shift) & 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Place in the last level that the first i positions give `symbol`; a difference of two is a count."""
        top = len(self.levels) - 1
        for k, (bits, zero) in enumerate(zip(self.levels, self.zeros)):
            one = bits.rank(i)
            i = np.where((symbol >> (top - k)) & 1, zero + one, i - one)
        return i


def _prefix_ranks(text: np.ndarray, depth: int) -> dict[int, np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols, up to at least `depth` (prefix doubling)."""
    n = len(text)
    out, r, k = {1: text}, text, 1
    while k < depth:
        r = _pair(r, k, r)
        k *= 2
        out[k] = r
    return out


def _pair(a: np.ndarray, k: int, b: np.ndarray) -> np.ndarray:
    """Dense ranks of (a[i], b[i+k]); beyond the end counts as smallest."""
    n = len(a)
    nxt = np.zeros(n, np.int64)
    if k < n:
        nxt[: n - k] = b[k:] + 1
    key = a.astype(np.int64) * (int(b.max(initial=0)) + 2) + nxt
    order = np.argsort(key)
    s = key[order]
    out = np.empty(n, np.int64)
    out[order] = np.r_[0, np.cumsum(s[1:] != s[:-1])] if n else []
    return out


class FMIndex:
    """text: symbols 1.. with 0 between the indexed segments; value: a number for each position; size: symbols in use.

    Holds for matches of up to `length` symbols. `lcp` is the common prefix of neighbouring suffixes, cut at `length`; the
    borders below a value cut the suffixes into the intervals of equal first symbols.
    """

    def __init__(self, text: np.ndarray, value: np.ndarray, length: int, size: int):
        self.n, self.length = len(text), length
        ranks = _prefix_ranks(text, 1 << max(0, int(length - 1).bit_length()))
        sa = np.argsort(ranks[max(ranks)], kind="stable")
        self.start = np.r_[0, np.cumsum(np.bincount(text, minlength=size))]
        self.wavelet = WaveletMatrix(text[sa - 1], size)
        self.symbol_first = self.wavelet.rank(np.arange(size), np.zeros(size, np.int64))
        self.lcp = np.r_[-1, np.minimum(self._common(ranks, sa[:-1], sa[1:]), length), -1]
        self._borders: dict[int, np.ndarray] = {}
        self.least = np.minimum.reduceat(value[sa], self.borders(length)[:-1])  # of each interval of `length` equal symbols

    def _common(self, ranks: dict[int, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        for k in sorted(ranks, reverse=True):
            x, y = a + out, b + out
            inside = np.maximum(x, y) < self.n
            out += k * (inside & (ranks[k][np.where(inside, x, 0)] == ranks[k][np.where(inside, y, 0)]))
        return out

    def borders(self, k: int) -> np.ndarray:
        """Where intervals of suffixes with k equal first symbols begin, and the end."""
        if k not in self._borders:
            self._borders[k] = np.flatnonzero(self.lcp < k)
        return self._borders[k]

    def interval(self, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The interval of k equal first symbols around each row."""
        b = self.borders(k)
        at = np.searchsorted(b, row, side="right")
        return b[at - 1], b[at]

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the suffixes that start with `symbol` and go on as those of [lo, hi) do."""
        base = self.start[symbol] - self.symbol_first[symbol]
        return base + self.wavelet.rank(symbol, lo), base + self.wavelet.rank(symbol, hi)

    def matching(self, flat: np.ndarray, first: np.ndarray, lengths: np.ndarray):
        """Streams patterns (slices of `flat`) against the index, from their ends backwards. A step that finds nothing
        shortens the match at its end to the next interval around it, until the step finds something or nothing is left.

        Yields (pattern numbers, starts, least values) wherever the matching statistic reaches `length`.
        """
        lo, hi, size = np.zeros(len(first), np.int64), np.full(len(first), self.n, np.int64), np.zeros(len(first), np.int64)
        order = np.argsort(-lengths, kind="stable")
        for step in range(int(lengths.max(initial=0))):
            act = order[: np.searchsorted(-lengths[order], -step, side="left")]
            pos = lengths[act] - 1 - step
            symbol = flat[first[act] + pos]
            full = act[size[act] == self.length]
            lo[full], hi[full] = self.interval(lo[full], self.length - 1)
            size[full] = self.length - 1
            new_lo, new_hi = self.extend(symbol, lo[act], hi[act])
            lost = np.flatnonzero((new_hi <= new_lo) & (size[act] > 0))
            while len(lost):
                who = act[lost]
                size[who] = np.maximum(np.minimum(np.maximum(self.lcp[lo[who]], self.lcp[hi[who]]), size[who] - 1), 0)
                for k in np.unique(size[who]).tolist():
                    own = who[size[who] == k]
                    lo[own], hi[own] = self.interval(lo[own], k)
                new_lo[lost], new_hi[lost] = self.extend(symbol[lost], lo[who], hi[who])
                lost = lost[(new_hi[lost] <= new_lo[lost]) & (size[who] > 0)]
            there = new_hi > new_lo
            lo[act], hi[act], size[act] = np.where(there, new_lo, 0), np.where(there, new_hi, self.n), np.where(there, size[act] + 1, 0)
            found = size[act] == self.length
            if found.any():
                row = lo[act[found]]
                yield act[found], pos[found], self.least[np.searchsorted(self.borders(self.length), row, side="right") - 1]
