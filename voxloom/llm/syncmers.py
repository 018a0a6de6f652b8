"""Document fingerprints of closed syncmers.

A k-mer of code points is chosen where the least hash among its inner s-mers stands first or
last in it.  The choice looks at nothing outside the k-mer, so an unchanged stretch of text keeps
its anchors wherever it moves, and at least one of any ``k - s + 1`` k-mers in a row is chosen.  A
fingerprint is the anchors in order: four bytes of hash and one byte of distance each, in base64.
Two fingerprints are alike by the longest chain of anchors that both have in the same order (their
longest common subsequence), ``2 * chain / (anchors of both)``.

``fingerprint_edits`` also needs each document's successor by key.  Rows are ordered by (key, hash
of the text) and dealt to cells between quantiles of that order, which come from a random sample of
bounded size and only serve balance; each task streams over its cells with one row of look-ahead, and
the first row of every cell goes a second time to the cell before it.  Equal rows of one key can
fill several cells: their successors are equal to themselves, so all but one in each dealing task
go to streams of their own.  The table of cells has at most ``MAX_CELLS`` rows, which is why it may be
broadcast.

Defined cases: a null text is empty; a text of fewer than k code points has one anchor, the hash of
the whole text, and an empty one none; two empty fingerprints are alike to degree 1, an empty and
another one 0; null keys come before all others; rows with the same key are ordered by a hash of the
text; a single row is its own successor; texts of any length are taken whole, piece by piece; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, S = 32, 8
MAX_CELLS = 20_000
ROWS_PER_CELL = 512
#: Rows of the sample for each cell.
SAMPLED = 16
#: Pairs of equal anchors that are followed one by one; beyond, whole words of bits are.
PAIRS = 1 << 22
#: Elements of a bit vector's step that cost as much as one of a run's.
RUN_COST = 500
#: Code points that are hashed at once.
PIECE = 1 << 19

_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_ODD[1])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_ODD[2])
    return h ^ (h >> np.uint64(31))


def gram_hashes(cp: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """Hashes of the grams of each size (powers of two, ascending), by doubling."""
    h, n, factor, found = cp.astype(np.uint64) * np.uint64(_ODD[0]) + np.uint64(_ODD[1]), 1, _ODD[2], []
    for size in sizes:
        while n < size:
            h = h[: len(h) - n] * np.uint64(factor) + h[n:]
            n, factor = 2 * n, factor * factor % (1 << 64)
        found.append(mix(h))
    return found


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        h, n = np.minimum(h[: len(h) - n], h[n:]), 2 * n
    return np.minimum(h[: len(h) - (width - n)], h[width - n :]) if n < width else h


def closed_syncmers(cp: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and 32-bit hashes of the chosen k-mers of one array of at least k code points."""
    small, large = gram_hashes(cp, s, k)
    width = k - s + 1
    least = sliding_min(small, width)
    chosen = np.flatnonzero((small[: len(least)] == least) | (small[width - 1 :] == least))
    return chosen, (large[chosen] >> np.uint64(32)).astype("<u4")


def anchors(texts: list[str], k: int = K, s: int = S) -> list[tuple[np.ndarray, np.ndarray]]:
    """Anchors of every text; short texts are hashed together, long ones piece by piece."""
    out: list = [None] * len(texts)
    group: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal group, size
        if not group:
            return
        lengths = np.array([len(texts[i]) for i in group])
        ends = np.cumsum(lengths)
        at, h = closed_syncmers(code_points("".join(texts[i] for i in group)), k, s)
        owner = np.searchsorted(ends, at, "right")
        inside = at + k <= ends[owner]
        at, h, owner = at[inside], h[inside], owner[inside]
        cut = np.searchsorted(owner, np.arange(len(group) + 1))
        for j, i in enumerate(group):
            out[i] = (at[cut[j] : cut[j + 1]] - (ends[j] - lengths[j]), h[cut[j] : cut[j + 1]])
        group, size = [], 0

    for i, t in enumerate(texts):
        if len(t) < k:
            whole = hashlib.blake2b(t.encode(), digest_size=4).digest()
            out[i] = (np.zeros(min(len(t), 1), "i8"), np.frombuffer(whole, "<u4")[: len(t)])
        elif len(t) > PIECE:
            parts = [(a, *closed_syncmers(code_points(t[a : a + PIECE + k - 1]), k, s)) for a in range(0, len(t) - k + 1, PIECE)]
            out[i] = (np.concatenate([a + p for a, p, _ in parts]), np.concatenate([h for *_, h in parts]))
        else:
            group.append(i)
            size += len(t)
            if size > PIECE:
                flush()
    flush()
    return out


def pack(places: np.ndarray, hashes: np.ndarray) -> str:
    rows = np.zeros(len(hashes), dtype=[("h", "<u4"), ("step", "u1")])
    rows["h"], rows["step"] = hashes, np.minimum(np.diff(places, prepend=0), 255)
    return base64.b64encode(rows.tobytes()).decode("ascii")


def _chain_of_pairs(x: list, y: list) -> int:
    """Longest common subsequence by the pairs of equal elements."""
    where: dict[int, list[int]] = {}
    for j in range(len(y) - 1, -1, -1):
        where.setdefault(y[j], []).append(j)
    ends: list[int] = []  # least last place of a chain of each length
    for h in x:
        for j in where[h]:
            at = bisect_left(ends, j)
            ends[at : at + 1] = [j]
    return len(ends)


def _chain_of_bits(x: list, y: np.ndarray) -> int:
    """Longest common subsequence with a bit for each element of y; zeros mark the steps of the chain."""
    full = (1 << len(y)) - 1
    order = np.argsort(y, kind="stable")
    values, first, times = np.unique(y[order], return_index=True, return_counts=True)
    number = {int(v): k for k, v in enumerate(values)}

    def places(h: int) -> int:
        k = number[h]
        bits = np.zeros(len(y), np.uint8)
        bits[order[first[k] : first[k] + times[k]]] = 1
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    often = {int(values[k]): None for k in np.flatnonzero(times > 256)}
    v = full
    for h in x:
        m = often.get(h)
        if m is None:
            m = places(h)
            if h in often:
                often[h] = m
        u = v & m
        v = (v + u | v - u) & full
    return len(y) - v.bit_count()


def _sliding_most(v: np.ndarray, n: int) -> np.ndarray:
    """Of each place the most of the ``n`` values that end there, fewer at the start."""
    done, out = 1, v
    while done < n:
        step = min(done, n - done)
        out = np.concatenate([out[:step], np.maximum(out[step:], out[:-step])])
        done += step
    return out


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of one element begin."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]])


def _chain_of_runs(x: np.ndarray, y: np.ndarray) -> int:
    """Longest common subsequence by runs of x: one step over y for each, however long the run.

    ``row[j]`` is the chain of what is done of x and the first j of y.  A run of n equal elements adds min(n, those
    in y[i:j]) to the best row[i]; with c[j] of them before j that is c[j] plus the most of row[i] - c[i] over
    the i whose c[i] lies within n of c[j], and among those with one c[i] the last is best.
    """
    row = np.zeros(len(y) + 1, np.int64)
    begin = _runs(x)
    for h, n in zip(x[begin].tolist(), np.diff(np.append(begin, len(x))).tolist()):
        places = np.flatnonzero(y == h)
        if n == 1 and len(places) <= 64:  # each place lifts what follows it as far as the next rise
            for p in places[::-1].tolist():
                up = row[p] + 1
                row[p + 1 : np.searchsorted(row, up)] = up
            continue
        if not len(places):
            continue
        best = row[places] - np.arange(len(places))  # the last i with each c[i] that has a next h
        most = _sliding_most(best, min(n, len(places)))  # over the n values before each c[j]
        # a row's own place and, from its last h on, what that brings; rows between two h's take over the one before
        brought = most + np.arange(1, len(places) + 1)
        after = int(places[0]) + 1
        upto = np.repeat(np.arange(len(places)), np.diff(np.append(places, len(y))))  # c[j] - 1, from there on
        np.maximum(row[after:], brought[upto], out=row[after:])
    return int(row[-1])


def _chain(x: np.ndarray, y: np.ndarray) -> int:
    """The longest common subsequence of two sequences of the same elements, the cheapest way."""
    values, nx = np.unique(x, return_counts=True)
    _, ny = np.unique(y, return_counts=True)
    if len(values) == 1:
        return min(len(x), len(y))
    if int(nx @ ny) <= PAIRS:
        return _chain_of_pairs(x.tolist(), y.tolist())
    if len(_runs(x)) * len(y) > len(_runs(y)) * len(x):
        x, y = y, x
    if len(_runs(x)) * RUN_COST < len(x):
        return _chain_of_runs(x, y)
    return _chain_of_bits(x.tolist(), y)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the longest common chain over the number of anchors of both.

    Common ends cost one look, and runs of one anchor, as constant text gives them, one step each.
    """
    total = len(a) + len(b)
    if not total:
        return 1.0
    m = min(len(a), len(b))
    differs = np.flatnonzero(a[:m] != b[:m])
    head = int(differs[0]) if len(differs) else m
    a, b, m = a[head:], b[head:], m - head
    differs = np.flatnonzero(a[len(a) - m :][::-1] != b[len(b) - m :][::-1])
    tail = int(differs[0]) if len(differs) else m
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    x, y = a[np.isin(a, b)], b[np.isin(b, a)]
    chain = head + tail
    if len(x):
        chain += _chain(x, y)
    return 2.0 * chain / total


def order_bytes(ids: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """Fixed strings of bytes that sort as (key, hash), null keys first."""
    out = np.zeros((len(hashes), 17), np.uint8)
    there = ids.is_valid().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out[:, 0] = there
    out[:, 1:9] = (number.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 9:] = (hashes.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S17").ravel()


@dataclass
class Cells:
    """Cells between bounds of the order; ``streams`` counts the streams of the key that opens each cell."""

    bounds: np.ndarray
    streams: np.ndarray

    @staticmethod
    def between(sample: np.ndarray, n: int) -> Cells:
        bounds = np.sort(sample)[:: max(1, len(sample) // n)][1:]
        bounds, times = np.unique(bounds, return_counts=True)
        return Cells(bounds, np.append(1, times))

    def of(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, keys, "right")


def _deal(batches: Iterator[pa.RecordBatch], cells: Cells, firsts: np.ndarray, before: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows with cell and stream, and the first row of each cell again for the cell before.

    Of the rows of a key that fills cells of its own, a task's first goes to the cell's main stream, the others by turns to
    streams that hold nothing else.
    """
    names = ["cell", "stream", "extra", "doc_id", "text", "h"]
    met: set[int] = set()
    turn = 0
    for b in batches:
        keys = order_bytes(b.column("doc_id"), b.column("h").to_numpy())
        cell = cells.of(keys)
        opens = firsts[cell] == keys
        stream = np.zeros(len(cell), np.int32)
        again = []
        many = np.flatnonzero(opens | (cell > 0) & (cells.streams[cell] > 1))
        for i in many.tolist():
            c = int(cell[i])
            if c not in met and opens[i]:
                met.add(c)
                again.append(i)
            elif c and cells.streams[c] > 1 and cells.bounds[c - 1] == keys[i]:
                turn += 1
                stream[i] = 1 + turn % int(cells.streams[c] - 1)
        kinds = [pa.int32(), pa.int32(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip((cell, stream, np.zeros(len(cell), bool)), kinds)), *b.columns], names)
        if again:
            extra = b.take(pa.array(again))
            where = before[cell[again]]
            yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip((where, np.zeros(len(where)), np.ones(len(where), bool)), kinds)), *extra.columns], names)


def _stream(batches: Iterator[pa.RecordBatch], names: list[str], k: int, s: int) -> Iterator[pa.RecordBatch]:
    """Rows come in the order (cell, stream, extra, key); an extra row only serves as a successor.

    A stream other than a cell's first holds equal rows alone, whose last one is followed by one of them.
    """
    before = None  # cell and stream, key, text, anchors of the row that awaits its successor

    def out(pairs: list, key_type: pa.DataType) -> pa.RecordBatch:
        edited = []
        for (_, _, text, _), follower, _ in pairs:
            half = len(text) // 2
            edited.append(text[: len(text) - half] + follower[:half])
        made = anchors(edited, k, s)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p[0][1] for p in pairs], key_type),
                pa.array([len(p[0][2]) for p in pairs], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array([pack(*p[0][3]) for p in pairs], pa.string()),
                pa.array([pack(*m) for m in made], pa.string()),
                pa.array([likeness(p[0][3][1], m[1]) for p, m in zip(pairs, made)], pa.float64()),
                pa.array([likeness(p[0][3][1], p[2][1]) for p in pairs], pa.float64()),
            ],
            names,
        )

    for whole in batches:
        at = 0
        texts_all = whole.column("text").to_pylist()
        kind = whole.schema.field("doc_id").type
        while at < whole.num_rows:
            to, size = at, 0
            while to < whole.num_rows and (to == at or size + len(texts_all[to]) <= PIECE):
                size, to = size + len(texts_all[to]), to + 1
            b, texts = whole.slice(at, to - at), texts_all[at:to]
            at = to
            pairs = []
            columns = (b.column(i).to_pylist() for i in range(4))
            for cell, stream, extra, key, text, found in zip(*columns, texts, anchors(texts, k, s)):
                if before is not None and before[0] == (cell, stream):
                    pairs.append((before, text, found))
                elif before is not None and before[0][1]:
                    pairs.append((before, before[2], before[3]))
                before = None if extra else ((cell, stream), key, text, found)
            yield out(pairs, kind)
    if before is not None and before[0][1]:
        yield out([(before, before[2], before[3])], kind)


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edit towards the next document, with likenesses."""
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    slim = slim.withColumn("h", F.xxhash64("text"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = ["long", "long", "string", "string", "string", "double", "double"]

    keys = slim.select("doc_id", "h")
    n = keys.count()
    n_cells = max(1, min(MAX_CELLS, n // ROWS_PER_CELL))
    sampled = keys.sample(min(1.0, n_cells * SAMPLED / max(n, 1)), seed=1).toArrow().combine_chunks()
    cells = Cells.between(order_bytes(pa.array(sampled.column(0).to_pylist(), pa.int64()), np.array(sampled.column(1).to_pylist(), np.int64)), n_cells)

    # the first key of every cell that has rows; the last cell's successor is the first row of all
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, bytes] = {}
        for b in batches:
            own = order_bytes(b.column("doc_id"), b.column("h").to_numpy())
            order = np.argsort(own, kind="stable")[::-1]  # the least key of a cell is written last
            found |= {c: min(x, found.get(c, x)) for c, x in dict(zip(cells.of(own)[order].tolist(), own[order].tolist())).items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.binary())], ["cell", "first"])

    rows = keys.mapInArrow(least, "cell int, first binary").groupBy("cell").agg(F.min("first").alias("first")).orderBy("cell").collect()
    firsts = np.zeros(len(cells.bounds) + 1, "S17")
    before = np.zeros(len(firsts), np.int64)
    for i, r in enumerate(rows):
        firsts[r["cell"]], before[r["cell"]] = bytes(r["first"]), rows[i - 1]["cell"]
    shipped = docs.sparkSession.sparkContext.broadcast((cells, firsts, before))

    dealt = slim.mapInArrow(lambda batches: _deal(batches, *shipped.value), "cell int, stream int, extra boolean, doc_id long, text string, h long")
    dealt = dealt.repartition("cell", "stream").sortWithinPartitions("cell", "stream", "extra", "doc_id", "h")
    return dealt.mapInArrow(lambda batches: _stream(batches, names, k, s), ", ".join(map(" ".join, zip(names, kinds))))
