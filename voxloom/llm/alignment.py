"""Banded alignment of patterns inside texts, many pairs at a time."""

from __future__ import annotations

import numpy as np

#: Out of reach: more edits than any band has.
_NONE = np.int64(1) << 52


def banded(patterns: list[np.ndarray], regions: list[np.ndarray], band: int) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the best place of each pattern in its region of code points.

    Pattern position i meets region positions i .. i + band only, so a region of
    ``len(pattern) + band`` code points is covered; start and end are free.  Of equally good
    places the one that starts first is given.
    """
    if not patterns:
        return []
    sizes = np.array([len(p) for p in patterns])
    m, n, width = int(sizes.max()), len(patterns), band + 1
    pat = np.full((n, m), 0xFFFFFFFF, dtype=np.int64)
    txt = np.full((n, m + width + 1), 0xFFFFFFFE, dtype=np.int64)
    for k, (p, r) in enumerate(zip(patterns, regions)):
        pat[k, : len(p)] = p
        txt[k, : min(len(r), txt.shape[1])] = r[: txt.shape[1]]
    length = np.array([min(len(r), txt.shape[1]) for r in regions])
    one = np.int64(1) << 32  # cost in the high half, start in the low half: the least is the best, then the first
    slope = np.arange(width, dtype=np.int64) * one
    row = np.tile(np.arange(width, dtype=np.int64), (n, 1))
    row[np.arange(width) > length[:, None]] = _NONE
    ends = np.zeros((n, width), dtype=np.int64)
    for i in range(1, m + 1):
        step = row + one * (pat[:, i - 1 : i] != txt[:, i - 1 : i - 1 + width])
        step[:, :-1] = np.minimum(step[:, :-1], row[:, 1:] + one)
        row = np.minimum.accumulate(step - slope, axis=1) + slope
        row[i + np.arange(width) > length[:, None]] = _NONE
        done = sizes == i
        if done.any():
            ends[done] = row[done]
    at = ends.argmin(axis=1)
    best = ends[np.arange(n), at]
    return [(int(b >> 32), int(b & 0xFFFFFFFF), int(s + c)) for b, s, c in zip(best, sizes, at)]
