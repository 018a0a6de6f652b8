"""Benchmark decontamination by q-gram lemma filtering.

Every benchmark item is cut into windows of ``WINDOW`` characters, one every ``STRIDE``.  A window of m
characters that occurs with at most e edits shares at least ``m + 1 - q (e + 1)`` q-grams with
the place where it occurs, all on at most e + 1 neighbouring diagonals.  So a text is first
scanned for stretches with that many q-grams of any window; there the q-grams are counted by
window and by overlapping diagonal bands of twice that breadth; bands that reach the window's bound
are verified by banded alignment.  A document is contaminated where a window occurs within its
budget.  So an exact quotation of ``WINDOW + STRIDE - 1`` = 51 characters or more is found wherever in
the item it begins, shorter ones of 48 only where they hold a window, and yet shorter ones never.

The benchmark is the query set and is held against all documents in blocks whose index has a
bounded size (``passages.BLOCK`` code points).  A pass over the documents takes ``BLOCKS`` of them, and more only where one
item fills more; a task holds the indexes of ``BLOCKS`` blocks at most.  Passes are written before the next begins, so what
the driver has sent out for one doesn't stay.

Defined cases: items of one id are one item, whatever their texts, and repeated items count once; null or empty texts and items match nothing, nor do items of fewer than q
characters; letter case and the kind of white space don't count; repeated rows repeat in the
result; null ids stay null; empty tables give no rows; texts of any length are scanned whole, in
overlapping spans; other columns are not read (the filter passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .alignment import banded
from .common import discard, materialize
from .passages import BLOCK, SPAN, GramIndex, Shapes, Window, crowded, cut_windows, fold, meetings, short_hashes

Q = 8
WINDOW, STRIDE = 48, 4
RATE = 0.1
#: Most characters of neighbouring windows that are one pattern of the index.
PART = 1_024
#: Characters of an item that come to the driver in one row; a multiple of ``STRIDE``.
PIECE = 1 << 14
#: Blocks of one pass, and indexes that a task holds.
BLOCKS = 4
#: Windows that are aligned at once.
VERIFIED = 1_024

#: Fixed value: white space as Python's ``str.strip`` knows it.
_BLANKS = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


class Scanner:
    """Finds the windows of one block in texts.

    Neighbouring windows of an item are one pattern of at most ``PART`` characters, so each gram is
    indexed once, not once for every window that holds it.
    """

    def __init__(self, windows: list[Window]):
        self.windows = windows
        parts: list[list] = []  # first window, end in the item, pieces of code points
        owner, start = [], []
        for i, w in enumerate(windows):
            end = w.start + len(w.cp)
            if parts:
                v, upto, pieces = windows[parts[-1][0]], parts[-1][1], parts[-1][2]
                last = windows[i - 1]
                joins = w.item == last.item and w.least == v.least and last.start < w.start <= upto < end <= v.start + PART
            if parts and joins:
                pieces.append(w.cp[upto - w.start :])
                parts[-1][1] = end
            else:
                parts.append([i, end, [w.cp]])
            owner.append(len(parts) - 1)
            start.append(w.start - windows[parts[-1][0]].start)
        self.start = np.array(start, dtype=np.int64)
        self.first = np.array([p[0] for p in parts] + [len(windows)], dtype=np.int64)
        cps = [np.concatenate(p[2]) for p in parts]
        self.index = GramIndex(Q, [(short_hashes(cp, Q), np.arange(len(cp) - Q + 1), i) for i, cp in enumerate(cps)])
        self.least = min((w.least for w in windows), default=1)
        self.edits = max((w.edits for w in windows), default=0)
        self.reach = max((len(w.cp) + w.edits for w in windows), default=Q)
        self.bound = np.array([w.least for w in windows], dtype=np.int64)
        self.grams = np.array([len(w.cp) - Q + 1 for w in windows], dtype=np.int64)
        half, head = self.edits + 1, self.first[:-1]
        self.breadth = 2 * half
        width = max(map(len, cps), default=Q) + WINDOW + 1
        self.shapes = Shapes(self.bound[head], self.grams[head] - 1, np.full(len(parts), self.breadth), width, self.reach, (0, half))

    def __call__(self, text: str, any_: bool = False) -> list[tuple[int, int, int, int]]:
        """(window, edits, start, end) of every window that occurs, or of the first found with ``any_``."""
        if not text or not self.windows:
            return []
        found: dict[int, tuple[int, int, int]] = {}
        seen: set[bytes] = set()
        step = SPAN - 2 * self.reach
        for a in range(0, max(1, len(text) - 2 * self.reach), step):
            exact = {w for w, x in found.items() if x[0] == 0}
            for w, edits, start, end in self._span(fold(text[a : a + SPAN]), exact, seen):
                if w not in found or (edits, start + a) < found[w][:2]:
                    found[w] = (edits, start + a, end + a)
                if any_:
                    return [(w, *found[w])]
        return [(w, *x) for w, x in sorted(found.items())]

    def _span(self, cp: np.ndarray, exact: set[int], seen: set[bytes]) -> Iterator[tuple[int, int, int, int]]:
        if len(cp) < Q:
            return
        at, k = self.index.present(cp)
        if len(at) < self.least:
            return
        keep = crowded(at, self.reach, self.least)
        for met in meetings(self.index, cp, at[keep], k[keep], self.shapes, seen):
            # the lemma's bound for each window of the band's pattern
            n = self.first[met.pattern + 1] - self.first[met.pattern]
            window = np.repeat(self.first[met.pattern] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            lowest = np.repeat(met.group * self.shapes.width, n) + self.start[window]
            held = np.searchsorted(met.key, lowest + self.grams[window]) - np.searchsorted(met.key, lowest)
            good = np.flatnonzero(held >= self.bound[window])
            low = np.repeat(met.low, n)[good] + self.start[window[good]]
            chosen = sorted(zip(low.tolist(), window[good].tolist()))
            for a in range(0, len(chosen), VERIFIED):
                now = [(max(0, d - self.edits), w) for d, w in chosen[a : a + VERIFIED] if w not in exact]
                patterns = [self.windows[w].cp for _, w in now]
                regions = [cp[begin : begin + len(p) + self.breadth + 2 * self.edits] for (begin, _), p in zip(now, patterns)]
                for (begin, w), (edits, start, end) in zip(now, banded(patterns, regions, self.breadth + 2 * self.edits)):
                    if edits <= self.windows[w].edits:
                        if not edits:
                            exact.add(w)
                        yield w, edits, begin + start, begin + end


def blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text", size: int = BLOCK) -> Iterator[list[Window]]:
    """The benchmark's windows in blocks of bounded size, read piece by piece.

    Long items are cut in Spark into pieces that overlap by a window less a stride, so neither a
    row that reaches the driver nor a block grows with an item.
    """
    stripped = F.btrim(F.col(text), F.lit(_BLANKS))
    items = benchmark.select(F.col(key).alias("item"), stripped.alias("text")).where(F.col("text").isNotNull()).distinct()
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.length("text") - WINDOW), F.lit(PIECE))
    pieces = items.select("item", "text", F.explode(starts).alias("start"))
    # texts of one item follow each other, and so do the pieces of a text
    pieces = pieces.orderBy("item", F.xxhash64("text"), "start").select("item", "start", F.expr(f"substring(text, start + 1, {PIECE + WINDOW - STRIDE})"))
    now: list[Window] = []
    held = 0
    for item, start, t in pieces.toLocalIterator():
        for w in cut_windows(item, t, WINDOW, RATE, Q, STRIDE, strip=False):
            w.start += start
            now.append(w)
        held += len(t)
        if held >= size:
            yield now
            now, held = [], 0
    if now:
        yield now


def passes(benchmark: DataFrame, key: str = "item_id") -> Iterator[list[list[Window]]]:
    """Blocks by pass: ``BLOCKS`` of them, and those after them that go on with the last one's item."""
    now: list[list[Window]] = []
    for block in blocks(benchmark, key):
        if block and len(now) >= BLOCKS and now[-1][-1].item != block[0].item:
            yield now
            now = []
        if block:
            now.append(block)
    if now:
        yield now


class Scanners:
    """The scanners of a pass; beyond ``BLOCKS`` they are made anew for each batch of texts."""

    def __init__(self, blocks_: list[list[Window]]):
        self.blocks, self.kept = blocks_, {}

    def __iter__(self) -> Iterator[Scanner]:
        for i, windows in enumerate(self.blocks):
            scanner = self.kept.get(i) or Scanner(windows)
            if i < BLOCKS - (len(self.blocks) > BLOCKS):
                self.kept[i] = scanner
            yield scanner


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """One row for each document and item that it holds, with the place and the edits."""
    spark = docs.sparkSession
    kinds = {k: d.schema[k].dataType.simpleString() for d, k in ((docs, key), (benchmark, item))}
    schema = f"doc_id {kinds[key]}, item_id {kinds[item]}, n_windows int, edits int, leak_start long, leak_end long"
    item_type = to_arrow_type(benchmark.schema[item].dataType)
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def scan(shipped) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanners = Scanners(shipped.value)
            for b in batches:
                by_pair: dict = {}
                texts = b.column("text").to_pylist()
                for scanner in scanners:
                    for i, t in enumerate(texts):
                        for w, edits, start, end in scanner(t):
                            by_pair.setdefault((i, scanner.windows[w].item), []).append((edits, start, end))
                rows = [(i, it, len(f), sum(x[0] for x in f), min(x[1] for x in f), max(x[2] for x in f)) for (i, it), f in by_pair.items()]
                cols = list(zip(*rows)) or [()] * 6
                types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                keys = b.column("doc_id").take(pa.array(cols[0], pa.int64()))
                items = pa.array(cols[1], item_type)
                yield pa.RecordBatch.from_arrays([keys, items, *(pa.array(c, t) for c, t in zip(cols[2:], types))], ["doc_id", "item_id", "n_windows", "edits", "leak_start", "leak_end"])

        return slim.mapInArrow(run, schema)

    found, last = None, None
    for blocks_ in passes(benchmark, item):
        if last is not None:
            part = materialize(scan(last), "leaks")
            last.destroy()
            found = part if found is None else found.unionByName(part)
        last = spark.sparkContext.broadcast(blocks_)
    if last is None:
        return spark.createDataFrame([], schema)
    return scan(last) if found is None else found.unionByName(scan(last))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    at = docs.columns.index(text)

    def clean(shipped, kept: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanners = Scanners(shipped.value)
            for b in batches:
                texts = b.column(at).to_pylist()
                good = np.ones(len(texts), bool)
                for scanner in scanners:
                    for i in np.flatnonzero(good).tolist():
                        good[i] = not scanner(texts[i], any_=True)
                yield b.filter(pa.array(good))

        return kept.mapInArrow(run, docs.schema)

    given, last = docs, None
    for blocks_ in passes(benchmark, item):
        if last is not None:
            before, docs = docs, materialize(clean(last, docs), "clean")
            last.destroy()
            if before is not given:
                discard(before)
        last = docs.sparkSession.sparkContext.broadcast(blocks_)
    return docs if last is None else clean(last, docs)
