"""A compressed FM-index over sequences of whole numbers, with matching statistics by backward search.

The sequences are laid end to end, each closed by a terminator that sorts first. Suffixes are sorted by prefix doubling,
deep enough for patterns of ``cap`` symbols. The Burrows-Wheeler transform is kept as a wavelet tree (one packed bit vector
for each bit of a symbol, levels in the order of a wavelet matrix, with one count for every 64 bits), so it takes about
log2(alphabet) * 1.5 bits for each symbol. Searches are vectorised: all sequences of a batch take a step at once.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class Bits:
    """A packed bit vector that counts the ones before a position."""

    def __init__(self, bits: np.ndarray):
        words = -(-(bits.size + 1) // 64)
        padded = np.zeros(words * 64, np.uint8)
        padded[: bits.size] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(words, np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = bits.size - int(bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletTree:
    """How often a symbol occurs before a position."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        now = symbols
        for bit in range(bits - 1, -1, -1):
            ones = (now >> bit) & 1
            self.levels.append(Bits(ones.astype(np.uint8)))
            now = np.concatenate([now[ones == 0], now[ones == 1]])

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where ``at`` falls on the last level on the way of ``symbol``; differences of two such places are counts."""
        for level, bit in zip(self.levels, range(self.bits - 1, -1, -1), strict=True):
            ones = level.ones(at)
            at = np.where((symbol >> bit) & 1, level.zeros + ones, at - ones)
        return at


class FMIndex:
    """Index of ``sequences`` (their symbols back to back, any whole numbers, and their lengths)."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, cap: int):
        self.cap = cap
        self.alphabet, own = np.unique(symbols, return_inverse=True)
        of = np.repeat(np.arange(lengths.size), lengths)
        self.starts = np.cumsum(lengths) - lengths + np.arange(lengths.size)
        text = np.zeros(symbols.size + lengths.size, np.int64)
        text[np.arange(symbols.size) + of] = own.ravel() + 1
        n = text.size
        ranks, size = [text], 1
        order = np.argsort(text, kind="stable")
        while size < cap:  # ranks by the first 1, 2, 4 ... symbols; past the end nothing follows
            rank = ranks[-1]
            ahead = np.zeros(n, np.int64)
            ahead[: max(0, n - size)] = rank[size:] + 1
            key = rank * np.int64(n + 2) + ahead
            order = np.argsort(key, kind="stable")
            new = np.zeros(n, bool)
            new[1:] = key[order[1:]] != key[order[:-1]]
            nxt = np.empty(n, np.int64)
            nxt[order] = np.cumsum(new)
            ranks.append(nxt)
            size *= 2
        self.order = order
        # common prefixes of neighbours in the order, up to cap
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(0, n - 1), np.int64)
        for step, rank in zip([1 << k for k in range(len(ranks) - 1, -1, -1)], ranks[::-1], strict=True):
            same = (a < n) & (b < n)
            same[same] = rank[a[same]] == rank[b[same]]
            common += step * same
            a, b = a + step * same, b + step * same
        self.common = np.zeros(n + 1, np.int16)
        self.common[1:n] = np.minimum(common, cap)
        self.common[0] = self.common[n] = -1
        # the transform, and where the suffixes of each symbol begin
        bits = max(1, int(self.alphabet.size).bit_length())
        self.bwt = WaveletTree(np.where(order > 0, text[order - 1], 0), bits)
        self.first = np.searchsorted(np.sort(text), np.arange(self.alphabet.size + 2))
        self.base = self.bwt.step(np.arange(self.alphabet.size + 1), np.zeros(self.alphabet.size + 1, np.int64))
        # widest intervals with a common prefix of cap - 1 and of cap
        self.runs = {depth: self._runs(depth) for depth in (cap - 1, cap)}
        self.least = [self.common]
        while 2 << (len(self.least) - 1) <= n + 1:
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def _runs(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        begins = np.flatnonzero(self.common[:-1] < depth)
        of = np.cumsum(self.common[:-1] < depth) - 1
        return begins[of], np.append(begins[1:], self.common.size - 1)[of]

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """Number of each symbol in the index's alphabet, 0 for those it doesn't have."""
        if not self.alphabet.size:
            return np.zeros(symbols.size, np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, symbols), self.alphabet.size - 1)
        return np.where(self.alphabet[at] == symbols, at + 1, 0)

    def extend(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the suffixes in [low, high) with the symbol before them."""
        begin = self.first[code] - self.base[code]
        low, high = begin + self.bwt.step(code, low), begin + self.bwt.step(code, high)
        return low, np.where(code == 0, low, high)

    def widen(self, low: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The widest intervals around ``low`` whose suffixes share ``depth`` symbols."""
        left, right = low.copy(), low + 1
        for k in range(len(self.least) - 1, -1, -1):
            size, table = 1 << k, self.least[k]
            go = left - size + 1 >= 0
            go[go] = table[left[go] - size + 1] >= depth[go]
            left = left - size * go
            go = right + size <= self.common.size
            go[go] = table[right[go]] >= depth[go]
            right = right + size * go
        return left, right

    def matching_statistics(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each symbol of the streamed sequences the length of the longest match that starts there (``cap`` at most)
        and the interval of the suffixes that begin with it."""
        code = self.codes(symbols)
        begins = np.cumsum(lengths) - lengths
        length, lows, highs = (np.zeros(symbols.size, np.int64) for _ in range(3))
        n = self.common.size - 1
        low, high, have = np.zeros(lengths.size, np.int64), np.full(lengths.size, n, np.int64), np.zeros(lengths.size, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            own = np.flatnonzero(lengths >= back)
            at = begins[own] + lengths[own] - back
            full = own[have[own] == self.cap]  # a match as long as counts gives up its last symbol
            if full.size:
                begin, end = self.runs[self.cap - 1]
                low[full], high[full], have[full] = begin[low[full]], end[low[full]], self.cap - 1
            open_, symbol = own, code[at]
            while open_.size:
                a, b = self.extend(symbol, low[open_], high[open_])
                found = a < b
                done = open_[found]
                low[done], high[done], have[done] = a[found], b[found], have[done] + 1
                left = ~found
                symbol, open_ = symbol[left], open_[left]
                if not open_.size:
                    break
                never = (have[open_] == 0) | (symbol == 0)  # no match starts here
                gone = open_[never]
                low[gone], high[gone], have[gone] = 0, n, 0
                symbol, open_ = symbol[~never], open_[~never]
                if open_.size:  # the longest shorter prefix that more suffixes share
                    have[open_] = np.maximum(0, np.minimum(have[open_] - 1, np.maximum(self.common[low[open_]], self.common[high[open_]])))
                    low[open_], high[open_] = self.widen(low[open_], have[open_])
                    top = open_[have[open_] == 0]
                    low[top], high[top] = 0, n
            length[at], lows[at], highs[at] = have[own], low[own], high[own]
        return length, lows, highs

    def least_in_runs(self, value: np.ndarray) -> np.ndarray:
        """By place in the order: the least ``value`` (one for each position of the laid out text) among the suffixes that
        share ``cap`` symbols."""
        n = self.common.size - 1
        if not n:
            return np.zeros(0, value.dtype)
        begins = np.flatnonzero(self.common[:-1] < self.cap)
        return np.repeat(np.minimum.reduceat(value[self.order], begins), np.diff(np.append(begins, n)))
