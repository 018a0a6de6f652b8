"""Words of many texts at once, as places in a dictionary, and rolling hashes over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .syncmers import mix

#: Bytes of text that are coded together; a longer text is coded alone.
GROUP = 1 << 22
#: Bytes that are cut into Python words at once.
SLICE = 1 << 21

#: Rows of counts that a task holds before it hands them on.
HELD = 1 << 18

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def groups(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = GROUP) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with texts of about ``most`` bytes together."""
    for b in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, "right"))
            end = max(end, at + 1)
            yield b.slice(at, end - at)
            at = end


def slices(raw: bytes) -> Iterator[bytes]:
    """The bytes cut at blanks into parts of about ``SLICE``; the blanks at the cuts are left out."""
    at = 0
    while len(raw) - at > SLICE:
        cut = raw.find(b" ", at + SLICE)
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut + 1
    yield raw[at:]


def coded(raws: list[bytes], split: Callable[[bytes], list[bytes]] = bytes.split) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(dictionary, place of each word in it, words of each text); few words are Python objects at a time."""
    arrays, pending, sizes = [], [], []
    for raw in raws:
        n = 0
        for part in slices(raw):
            found = split(part)
            n += len(found)
            pending += found
            if len(pending) > SLICE // 4:
                arrays.append(pa.array(pending, pa.large_binary()))
                pending = []
        sizes.append(n)
    arrays.append(pa.array(pending, pa.large_binary()))
    d = pa.concat_arrays(arrays).dictionary_encode()
    return d.dictionary, d.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.array(sizes, np.int64)


def summed(batches: Iterator[pa.RecordBatch], count: str, most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Rows alike but for ``count`` become one with its sum, over as many batches as a task may hold rows of."""
    held, n = [], 0

    def merged() -> pa.Table:
        table = pa.Table.from_batches(held)
        sums = table.group_by([c for c in table.column_names if c != count]).aggregate([(count, "sum")])
        return sums.rename_columns([count if c == f"{count}_sum" else c for c in sums.column_names]).select(table.column_names)

    for b in batches:
        held.append(b)
        n += b.num_rows
        if n > most:
            table = merged()
            if 2 * table.num_rows > most:
                yield from table.to_batches(max_chunksize=most // 8)
                held, n = [], 0
            else:
                held, n = table.combine_chunks().to_batches(), table.num_rows
    if held:
        yield from merged().to_batches(max_chunksize=most // 8)


def word_hasher(seed: str = "") -> Callable[[bytes], int]:
    """A 64-bit hash of a word, never 0, apart for each seed."""
    s = xxhash.xxh3_64_intdigest(seed.encode()) if seed else 0
    return lambda word: xxhash.xxh3_64_intdigest(word, s) or 1


def word_hashes(dictionary: pa.Array, seed: str = "") -> np.ndarray:
    return np.fromiter(map(word_hasher(seed), dictionary.to_pylist()), np.uint64, len(dictionary))


def rolling(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every ``n`` consecutive codes; equal runs have equal hashes."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    size = len(codes) + 1
    power = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE, np.uint64)], dtype=np.uint64)
    back = np.cumprod(np.r_[np.uint64(1), np.full(size - n - 1, _INVERSE, np.uint64)], dtype=np.uint64)
    upto = np.r_[np.uint64(0), np.cumsum(codes * power[: len(codes)], dtype=np.uint64)]
    return mix((upto[n:] - upto[:-n]) * back)
