"""Word shingles and fast similarity sketches."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from .syncmers import mix
from .words import slices

WORDS = 5
#: Coordinates of a sketch, cut into ``BANDS`` bands of ``ROWS``.
BANDS, ROWS = 32, 6
SIZE = BANDS * ROWS
#: Distinct words whose hashes a task remembers before it starts anew.
MEMO = 150_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, 2 * SIZE + 1, dtype=np.uint64) * _BASE)


class WordHashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles.

    Words are cut at ASCII white space and A-Z count as a-z; with fewer than five words the whole
    sequence is one shingle, and without any there is none.
    """
    hashed = [np.zeros(0, np.uint64)]
    for part in slices(text.encode("utf-8").lower()) if text else ():
        words = part.split()
        hashed.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
    w = np.concatenate(hashed)
    if not len(w):
        return w
    n = max(1, len(w) - WORDS + 1)
    h = np.full(n, min(len(w), WORDS), dtype=np.uint64)
    for j in range(min(len(w), WORDS)):
        h = h * _BASE + w[j : j + n]
    return np.unique(mix(h))


def sketch(items: np.ndarray) -> np.ndarray:
    """Fast similarity sketch: equal coordinates of two sketches estimate the Jaccard similarity.

    In each of the first SIZE rounds every item falls into one bin by that round's hash; in round
    SIZE + j every item falls into bin j.  A bin keeps the least (round, value).  As rounds are ordered,
    several are done at once, and the work ends when every bin is filled.
    """
    out = np.full(SIZE, np.iinfo(np.uint64).max, dtype=np.uint64)
    done = 0
    rounds = min(SIZE, int(SIZE * (np.log(SIZE) + 2) / len(items)) + 1)
    while done < SIZE:
        r = np.arange(done, min(done + rounds, SIZE))
        h = mix(items[None, :] ^ _SEEDS[r, None])
        bins = ((h >> np.uint64(32)) * np.uint64(SIZE)) >> np.uint64(32)
        value = (h & np.uint64(0xFFFFFFFF)) | (r.astype(np.uint64)[:, None] << np.uint64(32))
        np.minimum.at(out, bins.ravel().astype(np.intp), value.ravel())
        done += len(r)
        empty = np.flatnonzero(out == np.iinfo(np.uint64).max)
        if not len(empty):
            return out
    h = mix(items[None, :] ^ _SEEDS[SIZE + empty, None]) & np.uint64(0xFFFFFFFF)
    out[empty] = h.min(axis=1) | ((SIZE + empty).astype(np.uint64) << np.uint64(32))
    return out


_POWERS = np.array([pow(int(_BASE), j + 1, 1 << 64) for j in range(SIZE)], dtype=np.uint64)
_BAND = np.arange(1, SIZE + 1, dtype=np.uint64) * _SEEDS[:SIZE]


def band_keys(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key a band of ``rows`` coordinates; the band's number is part of it."""
    n = SIZE // rows
    return mix((mix(coordinates[: n * rows]).reshape(n, rows) * _POWERS[:rows]).sum(axis=1, dtype=np.uint64) ^ _BAND[:n]).view(np.int64)


def digest(items: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()
