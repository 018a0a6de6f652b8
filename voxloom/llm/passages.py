"""What passage search shares: folded code points and a packed index of pattern windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from .syncmers import code_points

#: Most code points of patterns in one block; a block's index is broadcast.
BLOCK = 1 << 19
#: Code points of a text that are scanned at once.
SPAN = 1 << 19
#: Characters of a region of a text, whose grams are held against the index as a set first.
REGION = 256
#: Pairs of a place and an occurrence that are held at once; one region's own may be more, see ``meetings``.
HELD = 1 << 20
_LUT_BITS = 22


def fold(text: str) -> np.ndarray:
    """Code points in lower case with every white space a blank; as many as the text has."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    cp = code_points(low).copy()
    cp[cp - np.uint32(9) < 5] = 32
    if not low.isascii():
        cp[np.isin(cp, (0x85, 0xA0, 0x2028, 0x2029))] = 32
    return cp


def short_hashes(cp: np.ndarray, q: int) -> np.ndarray:
    """32-bit hashes of the q-grams (q a power of two); a collision only adds a candidate."""
    h, n, factor = cp * np.uint32(0x9E3779B1), 1, 0x85EBCA6B
    while n < q:
        step = h[: len(h) - n] * np.uint32(factor)
        step += h[n:]
        h, n, factor = step, 2 * n, factor * factor % (1 << 32)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h


@dataclass
class Window:
    """A stretch of one pattern that is matched as a whole."""

    item: object
    item_size: int
    start: int
    cp: np.ndarray
    edits: int
    least: int


def cut_windows(item: object, text: str, size: int, rate: float, q: int, stride: int | None = None, strip: bool = True) -> list[Window]:
    """Windows every ``stride`` characters (half-overlapping without); ``least`` is the q-gram lemma's bound, m + 1 - q (e + 1)."""
    cp = fold(text.strip() if strip else text)
    m = min(size, len(cp))
    if m < q:
        return []
    edits = int(rate * m)
    while edits and m + 1 - q * (edits + 1) < 1:
        edits -= 1
    starts = [*range(0, len(cp) - m, stride or max(1, m // 2)), len(cp) - m]
    return [Window(item, len(cp), s, cp[s : s + m], edits, m + 1 - q * (edits + 1)) for s in starts]


class GramIndex:
    """Inverted index from gram hashes to (window, offset), with a small table in front."""

    def __init__(self, q: int, entries: list[tuple[np.ndarray, np.ndarray, int]]):
        """entries: hashes, their offsets and the number of their window."""
        self.q = q
        h = np.concatenate([e[0] for e in entries]) if entries else np.zeros(0, np.uint32)
        offset = np.concatenate([e[1] for e in entries]) if entries else np.zeros(0, np.int64)
        window = np.concatenate([np.full(len(e[0]), e[2], np.int64) for e in entries]) if entries else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.offset, self.window = offset[order], window[order]
        self.keys, self.first = np.unique(h[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(h)))
        self.table = np.zeros(1 << _LUT_BITS, dtype=bool)
        self.table[self.keys >> np.uint32(32 - _LUT_BITS)] = True

    def present(self, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the text whose gram occurs, and the gram's number."""
        h = short_hashes(cp, self.q)
        at = np.flatnonzero(self.table[h >> np.uint32(32 - _LUT_BITS)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[k] == h[at]
        return at[same], k[same]

    def expand(self, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, window, offset) of every occurrence of the grams."""
        n = self.count[k]
        row = np.repeat(self.first[k] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return np.repeat(at, n), self.window[row], self.offset[row]


def crowded(at: np.ndarray, reach: int, least: int) -> np.ndarray:
    """Which of the ascending places lie in a stretch of ``reach`` characters with ``least`` places or more."""
    ahead = np.searchsorted(at, at + reach, "left") - np.arange(len(at))
    starts = np.flatnonzero(ahead >= least)
    covered = np.zeros(len(at) + 1, dtype=np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + ahead[starts], -1)
    return np.cumsum(covered[:-1]) > 0


def _runs(sizes: np.ndarray, group: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of whole groups (neighbouring equal numbers) whose sizes add up to ``most``, or of one group."""
    ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group))
    upto = np.cumsum(sizes)[ends - 1]
    at, done, g = 0, 0, 0
    while at < len(group):
        g = max(g + 1, int(np.searchsorted(upto, done + most, "right")))
        yield slice(at, int(ends[g - 1]))
        at, done = int(ends[g - 1]), int(upto[g - 1])


@dataclass
class Shapes:
    """What a meeting with a pattern takes, by pattern: ``least`` distinct offsets that lie at most
    ``span`` apart, in a band of ``breadth`` diagonals; bands begin at each of ``shifts``."""

    least: np.ndarray
    span: np.ndarray
    breadth: np.ndarray
    width: int  # more than the longest pattern and span together
    reach: int  # the most characters that an occurrence takes
    shifts: tuple[int, ...]

    def close(self, key: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        """Whether ``least`` sorted distinct keys from each one on lie within ``span``."""
        j = np.arange(len(key)) + self.least[pattern] - 1
        return (j < len(key)) & (key[np.minimum(j, len(key) - 1)] - key <= self.span[pattern])


@dataclass
class Meetings:
    """Bands of diagonals with enough grams: pattern and lowest diagonal of each, and the sorted keys ``group * width + offset``."""

    pattern: np.ndarray
    low: np.ndarray
    group: np.ndarray
    key: np.ndarray


def _is_new(cp: np.ndarray, seen: set[bytes]) -> bool:
    digest = hashlib.blake2b(cp.tobytes(), digest_size=16).digest()
    if digest in seen:
        return False
    seen.add(digest)
    return True


def meetings(index: GramIndex, cp: np.ndarray, at: np.ndarray, k: np.ndarray, shapes: Shapes, seen: set[bytes] | None) -> Iterator[Meetings]:
    """Where a text may hold patterns, in slices of bounded size and in the order of the text.

    The text is cut into regions that overlap by ``reach``, so every occurrence lies in one.  A region's
    grams are held against the index as a set first: a pattern needs enough offsets with any of them,
    however often the region repeats a gram.  Only then are places paired with offsets and counted by
    diagonal.  A region that is equal to an earlier one of the text (a run of one character, a repeated
    line) has nothing new and is passed over; ``seen`` holds their digests (None: none is passed over).

    Memory: the set of one region meets each offset of the index at most once, and a region and
    pattern pair at most the region's characters times the pattern's.
    """
    step = max(REGION, 4 * shapes.reach)
    region = at // step
    again = np.flatnonzero((at % step < shapes.reach) & (region > 0))
    place, gram = np.concatenate([at, at[again]]), np.concatenate([k, k[again]])
    region = np.concatenate([region, region[again] - 1])
    keep = slice(None)
    if seen is not None:
        new = [r for r in np.unique(region).tolist() if _is_new(cp[r * step : (r + 1) * step + shapes.reach + index.q], seen)]
        keep = np.isin(region, new)
    if not len(region[keep]):
        return
    n_grams, n_patterns, width = len(index.keys), len(shapes.least), shapes.width
    have = region[keep] * n_grams + gram[keep]
    order = np.argsort(have, kind="stable")
    have, place = have[order], place[keep][order]
    first = np.flatnonzero(np.diff(have, prepend=-1))
    sets, times = have[first], np.diff(np.append(first, len(have)))
    gram, region = sets % n_grams, sets // n_grams
    for part in _runs(index.count[gram], region, HELD):
        row, pattern, offset = index.expand(np.arange(part.start, part.stop), gram[part])
        key = (region[row] * n_patterns + pattern) * width + offset
        order = np.argsort(key, kind="stable")
        key, row, pattern = key[order], row[order], pattern[order]
        pair = key // width
        good = np.unique(pair[shapes.close(key, pattern)])
        if not len(good):
            continue
        inside = np.searchsorted(good, pair)
        inside = np.flatnonzero(good[np.minimum(inside, len(good) - 1)] == pair)
        row, pattern, offset, pair = row[inside], pattern[inside], key[inside] % width, pair[inside]
        for run in _runs(times[row], pair, HELD):
            r, n = row[run], times[row[run]]
            where = place[np.repeat(first[r] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())]
            which, off = np.repeat(pattern[run], n), np.repeat(offset[run], n)
            _, dense = np.unique(pair[run], return_inverse=True)
            dense = np.repeat(dense, n)
            for shift in shapes.shifts:
                breadth = shapes.breadth[which]
                band = (where - off + width + shift) // breadth
                n_bands = int(band.max()) + 1
                whole = np.unique((dense * n_bands + band) * width + off)
                group = whole // width
                owner = np.zeros(int(dense.max()) + 1, np.int64)
                owner[dense] = which
                close = np.unique(group[shapes.close(whole, owner[group // n_bands])])
                if len(close):
                    of = owner[close // n_bands]
                    yield Meetings(of, close % n_bands * shapes.breadth[of] - shift - width, close, whole)
