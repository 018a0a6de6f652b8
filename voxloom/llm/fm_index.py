"""A compressed full-text index over words: Burrows-Wheeler transform, wavelet matrix, backward search."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits in 64-bit words, with the ones before each word counted."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(packed.tobytes() + bytes(16 - len(packed) % 8), "<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels, self.zeros = [], []
        self.n_bits = max(1, int(n_symbols - 1).bit_length())
        begin = np.zeros(n_symbols, np.int64)
        every = np.arange(n_symbols)
        for bit in range(self.n_bits - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            level = BitVector(ones)
            self.levels.append(level)
            self.zeros.append(int(len(ones) - ones.sum()))
            begin = self._down(level, self.zeros[-1], (every >> bit) & 1 == 1, begin)
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.begin = begin  # where each symbol's run starts on the lowest level

    @staticmethod
    def _down(level: BitVector, zeros: int, one: np.ndarray, at: np.ndarray) -> np.ndarray:
        ones = level.rank(at)
        return np.where(one, zeros + ones, at - ones)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        for j, level in enumerate(self.levels):
            at = self._down(level, self.zeros[j], (symbol >> (self.n_bits - 1 - j)) & 1 == 1, at)
        return at - self.begin[symbol]


def _denser(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """(order, rank by value, whether all differ)."""
    order = np.argsort(key, kind="stable")
    new = np.diff(key[order], prepend=key[order[:1]] - 1) != 0
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order, rank, bool(new.all())


class FMIndex:
    """The words of several texts, each with the number of its document.

    ``first_documents`` streams other texts against it: of each place, how many words from it on also
    stand in an indexed text (up to the reach of the search), and the least document with the ``window`` words from it on.
    """

    def __init__(self, texts: list[list[bytes]], documents: list[int], window: int):
        self.window, self.count = window, len(texts)
        names = sorted({w for t in texts for w in t})
        self.symbol = {w: i for i, w in enumerate(names, 1)}  # 0 ends a text
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        n = self.size = int(sizes.sum())
        symbols = np.zeros(n, np.int64)
        ends = np.cumsum(sizes) - 1
        inner = np.ones(n, bool)
        inner[ends] = False
        symbols[inner] = np.fromiter((self.symbol[w] for t in texts for w in t), np.int64, n - len(texts))
        owner = np.repeat(np.array(documents, np.int64), sizes)

        # suffixes in order by prefix doubling; every end differs from the others, so no comparison passes one
        key = symbols + self.count
        key[ends] = np.arange(self.count)
        order, rank, done = _denser(key)
        known, ranks = 1, {1: rank}
        while not done:
            ahead = np.full(n, -1, np.int64)
            ahead[: max(n - known, 0)] = rank[known:]
            order, rank, done = _denser(rank * (n + 1) + ahead + 1)
            known *= 2
            ranks[known] = rank
        half = max(k for k in ranks if k <= window)  # ranks by so many words
        reach = window - half  # two overlapping halves make a window
        # only suffixes with a whole window can be met by one; the others join the group before them and own nothing there
        left = np.repeat(ends, sizes) - np.arange(n)  # words up to the end of the text
        whole = left[order] >= window
        head, tail = ranks[half][order], ranks[half][np.minimum(order + reach, n - 1)]
        new = whole & np.r_[True, (np.diff(head) != 0) | (np.diff(tail) != 0)]
        self.groups = BitVector(new)
        holders = np.where(whole, owner[order], np.iinfo(np.int64).max)
        self.least = np.minimum.reduceat(holders, np.flatnonzero(new)) if new.any() else np.zeros(0, np.int64)

        self.matrix = WaveletMatrix(symbols[order - 1], len(names) + 1)
        counts = np.bincount(symbols, minlength=len(names) + 1)
        self.start = np.cumsum(counts) - counts

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the rows whose suffix has the symbol before that of (low, high)."""
        both = self.matrix.rank(np.r_[symbol, symbol], np.r_[low, high]) + np.r_[self.start[symbol], self.start[symbol]]
        return both[: len(symbol)], both[len(symbol) :]

    def first_documents(self, texts: list[list[bytes]], none: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(matching lengths, least documents) by text and place; ``none`` where no window is indexed.

        All texts are searched side by side, each from its end to its start.  Where a match ends, the search of that text
        goes on from the last window that may still match.
        """
        codes = [np.array([self.symbol.get(w, -1) for w in t], np.int64) for t in texts]
        size = np.array([len(c) for c in codes], np.int64)
        begin = np.cumsum(size) - size
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        length, least = np.zeros(len(flat), np.int64), np.full(len(flat), none, np.int64)
        lane = np.flatnonzero(size > 0)  # texts still under search
        end = size[lane].copy()  # the match ends before this place
        at = end.copy()  # and starts here
        low, high = np.zeros(len(lane), np.int64), np.full(len(lane), self.size, np.int64)
        while len(lane):
            symbol = flat[begin[lane] + at - 1]
            known = symbol >= 0
            new_low, new_high = self.extend(np.where(known, symbol, 0), low, high)
            hit = known & (new_high > new_low)
            at = np.where(hit, at - 1, at)
            low, high = np.where(hit, new_low, 0), np.where(hit, new_high, self.size)
            matched = end - at
            place = (begin[lane] + at)[hit]
            length[place] = np.maximum(length[place], matched[hit])
            full = hit & (matched >= self.window)
            if full.any():
                least[(begin[lane] + at)[full]] = self.least[self.groups.rank(low[full] + 1) - 1]
            # the word before ``at`` can't be put before the match up to ``end``: search from an end further left,
            # where a window with that word may still match, or else before that word
            shorter = np.where(matched >= self.window, at - 1 + self.window, end - 1)
            shorter = np.where(known, shorter, at - 1)
            end = np.where(hit, end, np.minimum(shorter, end - 1))
            at = np.where(hit, at, end)
            go = at > 0
            lane, end, at, low, high = lane[go], end[go], at[go], low[go], high[go]
        cut = np.cumsum(size)[:-1]
        return np.split(length, cut), np.split(least, cut)
