"""Substring dedup: words inside a window of 50 that an earlier document holds, by compressed FM-indexes.

1. Every window has an anchor, the least hash of its runs of ``RUN`` words, so equal windows have equal anchors.
   Anchors that occur in one document only are left out, by a set of bits of bounded size (``bits``).
2. An anchor with ``HOT`` occurrences or more stands in a passage that many documents share, each between words of its
   own.  Of these, windows that occur in one document only are left out as well, by a second set of bits.
3. What is left is cut into pieces, runs of at most ``PIECE`` windows of one anchor.  Equal pieces count as one, with the
   least document that holds them; their words move once a task.
4. A shard holds the distinct pieces of many anchors, by hash, so equal windows meet in one shard.  It is compressed into
   an FM-index, and all its pieces are streamed against it: backward search over the wavelet matrix gives matching lengths,
   and for each window the least document of any piece that holds it.
5. Where that is an earlier document, a window of an occurrence of the piece is an interval to remove.  Intervals meet their
   documents in a join; documents without any are finished where they are read.

Hashes and bits only leave things out that can't match; what is removed is decided on the words themselves.  The number of
shards follows the number of pieces, so an index has a bounded size on average at any scale.

Defined cases: a null or empty text has no words; texts of fewer than 50 words are kept whole; a null id comes after
all others, and rows of one id (or without one) never remove anything from each other; a window that is repeated only
inside its own document stays; repeated rows are judged alike; texts are read whole, however long, and one of
millions of words is a single row of one task; an empty table gives no rows; other columns are not read.  Ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bits import Bits, bits_of
from .common import discard, materialize
from .fm_index import FMIndex
from .syncmers import mix
from .words import coded, groups, rolling, word_hashes

WINDOW = 50
#: Words of the runs among which a window's anchor is chosen.
RUN = 16
#: Occurrences from which an anchor's windows are counted one by one.
HOT = 1_000
#: Windows of one piece at most.
PIECE = 64
#: Pieces of a shard on average, and those that are searched side by side.
SHARD, STREAM = 8_000, 4_000
#: Pieces whose words a task remembers to have handed on.
MET = 200_000
#: Stands for a null id: after all others.
LAST = (1 << 63) - 1


def sliding_least(h: np.ndarray, n: int) -> np.ndarray:
    """The least of every ``n`` consecutive values."""
    if len(h) < n:
        return h[:0]
    done = 1
    while done * 2 <= n:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    return np.minimum(h[: len(h) - (n - done)], h[n - done :]) if n > done else h


class Windows:
    """All windows of a group of texts: first word, row and anchor of each."""

    def __init__(self, texts: list[str | None], window: int, run: int):
        self.words, self.ids, self.sizes = coded([t.encode("utf-8") if t else b"" for t in texts])
        self.window = window
        self.codes = word_hashes(self.words)[self.ids]
        row = np.repeat(np.arange(len(texts)), self.sizes)
        least = sliding_least(rolling(self.codes, run), window - run + 1)
        self.at = np.flatnonzero(row[: len(least)] == row[window - 1 : window - 1 + len(least)])
        self.row, self.anchor = row[self.at], mix(least[self.at])  # least hashes are small; mixed, they spread again

    def hashes(self) -> np.ndarray:
        return rolling(self.codes, self.window)[self.at]

    def runs(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(first, number) of the runs of consecutive windows with one row and anchor, among those kept."""
        at = np.arange(len(self.at)) if keep is None else np.flatnonzero(keep)
        if not len(at):
            return at, at
        new = np.r_[True, (np.diff(at) != 1) | (np.diff(self.at[at]) != 1) | (np.diff(self.row[at]) != 0) | (self.anchor[at[1:]] != self.anchor[at[:-1]])]
        begin = np.flatnonzero(new)
        return at[begin], np.diff(np.append(begin, len(at)))


def _extent(code: np.ndarray, document: np.ndarray) -> pa.RecordBatch:
    """(code, low, high, n): least and greatest document of each hash, and its occurrences."""
    order = np.lexsort((document, code))
    code, document = code[order], document[order]
    first = np.flatnonzero(np.r_[np.ones(min(len(code), 1), bool), code[1:] != code[:-1]])
    last = np.append(first[1:], len(code)) - 1 if len(first) else first
    columns = [code[first].view(np.int64), document[first], document[last], last - first + 1]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["code", "low", "high", "n"])


def _repeated(docs: DataFrame, window: int, run: int, hot: Bits | None = None) -> DataFrame:
    """(code, low, high, n) of the hashes that several documents hold: of anchors, or of windows with a hot anchor."""
    shipped = docs.sparkSession.sparkContext.broadcast(hot)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches):
            w, document = Windows(b.column("text").to_pylist(), window, run), b.column("document").to_numpy()
            if shipped.value is None:
                first, _ = w.runs()
                yield _extent(w.anchor[first], document[w.row[first]])
            else:
                at = np.flatnonzero(shipped.value.has(w.anchor))
                yield _extent(w.hashes()[at], document[w.row[at]])

    found = docs.select("document", "text").mapInArrow(scan, "code long, low long, high long, n long")
    return found.groupBy("code").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).where("low < high")


def _pieces(docs: DataFrame, window: int, run: int, repeated: Bits, hot: Bits, shared: Bits) -> DataFrame:
    """(anchor, document, text_hash, start, digest, piece): windows that may be repeated, with their words once a task."""
    shipped = docs.sparkSession.sparkContext.broadcast((repeated, hot, shared))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, hot, shared = shipped.value
        met: set[bytes] = set()
        for b in groups(batches):
            w = Windows(b.column("text").to_pylist(), window, run)
            keep = repeated.has(w.anchor)
            keep[keep] = ~hot.has(w.anchor[keep]) | shared.has(w.hashes()[keep])
            first, n = w.runs(keep)
            parts = -(-n // PIECE)  # long runs are cut
            nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            first, n = np.repeat(first, parts) + nth * PIECE, np.minimum(np.repeat(n, parts) - nth * PIECE, PIECE)
            words, digests, pieces = w.words.to_pylist(), [], []
            for a, k in zip(w.at[first].tolist(), n.tolist()):
                piece = b" ".join([words[i] for i in w.ids[a : a + k + window - 1].tolist()])
                digest = hashlib.blake2b(piece, digest_size=16).digest()
                digests.append(digest)
                pieces.append(None if digest in met else piece.decode("utf-8"))
                if len(met) >= MET:
                    met.clear()
                met.add(digest)
            row = w.row[first]
            start = w.at[first] - (np.cumsum(w.sizes) - w.sizes)[row]
            at = pa.array(row)
            columns = [pa.array(w.anchor[first].view(np.int64)), b.column("document").take(at), b.column("text_hash").take(at), pa.array(start), pa.array(digests, pa.binary()), pa.array(pieces, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "document", "text_hash", "start", "digest", "piece"])

    return docs.select("document", "text_hash", "text").mapInArrow(scan, "anchor long, document long, text_hash long, start long, digest binary, piece string")


def _first_holders(pieces: DataFrame, window: int, n_shards: int) -> DataFrame:
    """(digest, runs): for each distinct piece, runs (first, last, least) of windows with the least document that holds them."""
    shard = F.pmod(F.col("anchor"), F.lit(n_shards)).cast("int").alias("shard")
    distinct = pieces.groupBy(shard, "digest").agg(F.min("document").alias("document"), F.max("piece").alias("piece"))
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = [p.encode("utf-8").split() for p in pdf["piece"]]
        index = FMIndex(texts, pdf["document"].tolist(), window)
        runs = []
        for at in range(0, len(texts), STREAM):
            _, least = index.first_documents(texts[at : at + STREAM], LAST)
            for own in least:
                own = own[: len(own) - window + 1]
                new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                last = np.append(new[1:], len(own)) - 1
                runs.append([(a, z, d) for a, z, d in zip(new.tolist(), last.tolist(), own[new].tolist())])
        return pd.DataFrame({"digest": pdf["digest"], "runs": runs})

    return distinct.repartition(tasks, "shard").groupBy("shard").applyInPandas(search, "digest binary, runs array<struct<first:long,last:long,least:long>>")


def _intervals(pieces: DataFrame, holders: DataFrame, window: int) -> DataFrame:
    """(document, text_hash, first, last): stretches of words to remove."""
    found = pieces.select("document", "text_hash", "start", "digest").join(holders, "digest")
    found = found.select("document", "text_hash", "start", F.inline("runs")).where(F.col("least") < F.col("document"))
    return found.select("document", "text_hash", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last") + window).alias("last"))


_OUT = "n_words long, n_removed long, kept_text string, kept_sha256 string"


def _kept(text: str | None, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by blanks)."""
    words = text.encode("utf-8").split() if text else []
    gone, at, left = 0, 0, []
    for first, last in sorted(spans):
        left += words[at : max(first, at)]
        gone += max(0, last - max(first, at))
        at = max(at, last)
    return len(words), gone, b" ".join(left + words[at:])


def _finish(b: pa.RecordBatch, spans: list[list[tuple[int, int]]], with_text: bool) -> pa.RecordBatch:
    n, gone, kept, digests = [], [], [], []
    for t, own in zip(b.column("text"), spans):  # one text at a time
        n_words, n_gone, left = _kept(t.as_py(), own)
        n.append(n_words), gone.append(n_gone), digests.append(hashlib.sha256(left).hexdigest())
        kept.append(left.decode("utf-8") if with_text else None)
    columns = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *(c.split()[0] for c in _OUT.split(", "))])


def _hash(document: Column, text_hash: Column) -> Column:
    return F.xxhash64(document, text_hash)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, run: int = RUN, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, kept_sha256) of every document."""
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("document"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    named = named.withColumn("code", _hash(F.col("document"), F.col("text_hash")))
    anchors = materialize(_repeated(named, window, run), "anchors")
    common = bits_of(anchors.where(F.col("n") >= hot), "code")
    shared = materialize(_repeated(named, window, run, common).select("code"), "windows")
    pieces = materialize(_pieces(named, window, run, bits_of(anchors, "code"), common, bits_of(shared, "code")), "pieces")
    discard(anchors), discard(shared)

    n_shards = max(1, -(-pieces.where(F.col("piece").isNotNull()).count() // shard))
    holders = materialize(_first_holders(pieces, window, n_shards), "holders")
    intervals = materialize(_intervals(pieces, holders, window), "intervals")
    discard(holders), discard(pieces)

    # documents with intervals move to them; the others are finished where they are read
    marked = bits_of(intervals.select(_hash(F.col("document"), F.col("text_hash")).alias("code")).distinct(), "code")
    shipped = docs.sparkSession.sparkContext.broadcast(marked)
    schema = f"doc_id {kind}, {_OUT}"

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches):
            b = b.filter(pa.array(~shipped.value.has(b.column("code").to_numpy().view(np.uint64))))
            yield _finish(b, [[]] * b.num_rows, True)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(shipped.value.has(b.column("code").to_numpy().view(np.uint64))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches):
            spans = [[(s["first"], s["last"]) for s in own or ()] for own in b.column("spans").to_pylist()]
            yield _finish(b, spans, True)

    spans = intervals.groupBy("document", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    columns = ["doc_id", "document", "text_hash", "text", "code"]
    moving = named.select(*columns).mapInArrow(touched, named.select(*columns).schema).drop("code")
    moved = moving.join(spans, ["document", "text_hash"], "left").select("doc_id", "text", "spans")
    return named.select("doc_id", "text", "code").mapInArrow(untouched, schema).unionByName(moved.mapInArrow(cut, schema))
