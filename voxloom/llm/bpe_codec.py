"""BPE encoding and decoding by tree concatenation.

A text up to ``split_over`` characters is encoded in place.  A longer one is cut into leaves of
``leaf`` characters that are encoded in parallel as rows of their own (equal texts once); the leaves' ids
are then joined pairwise, level by level, into the ids of the whole text.  At each join the ids around the
cut are decoded and encoded anew, in a window that grows until it is bounded on both sides by
places where the splitting pattern always splits (before a blank that follows a non-blank) and
its first and last tokens are those that the sides already have.  Everything outside the window
then stands: matching runs forward only, so pieces from such a place on don't depend on what
precedes it, and pieces before it can't reach over it.  A side without such a place is
taken whole.

Defined cases: a null text is empty (no ids, digests of no bytes); special strings give their own
ids and part the text; repeated rows repeat in the result; a null doc_id stays null; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, encoder, read_vocabulary, special_splitter

SPLIT_OVER = 32_768
LEAF = 16_384


class Codec:
    """Ids of texts and texts of ids for one vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.enc, self.specials = vocab, encoder(vocab), special_splitter(vocab)
        self.special_ids = dict(vocab.specials)
        size = max([len(vocab.tokens), *(i + 1 for i in self.special_ids.values())])
        self.bytes_of = [*vocab.tokens, *[b""] * (size - len(vocab.tokens))]
        for s, i in vocab.specials:
            self.bytes_of[i] = s.encode()

    def sections(self, text: str) -> list[str]:
        """Plain and special strings by turns, plain ones at even places."""
        return self.specials.split(text) if self.specials else [text]

    def plain(self, text: str) -> np.ndarray:
        return np.asarray(self.enc.encode_ordinary(text), dtype="<u4")

    def encode(self, text: str) -> np.ndarray:
        parts = self.sections(text)
        if len(parts) == 1:
            return self.plain(text)
        return np.concatenate([np.array([self.special_ids[p]], "<u4") if k % 2 else self.plain(p) for k, p in enumerate(parts)])

    def raw(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.raw(ids).decode("utf-8", "replace")

    def join(self, left: np.ndarray, right: np.ndarray, window: int = 16) -> np.ndarray:
        """The ids of the joined text, given the ids of its two sides."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        while True:
            a, b = min(window, len(left)), min(window, len(right))
            found = self._window(left[len(left) - a :], right[:b], a == len(left), b == len(right))
            if found is not None:
                before, middle, after = found
                return np.concatenate([left[: len(left) - a + before], middle, right[after:]])
            window *= 2

    def _window(self, left: np.ndarray, right: np.ndarray, left_whole: bool, right_whole: bool):
        """(tokens of left kept, new tokens, tokens of right replaced), or None to grow.

        Sure places are sought between tokens of each side: bounds of pieces are bounds of tokens.
        """
        start, end = 0 if left_whole else self._sure(left, last=False), len(right) if right_whole else self._sure(right, last=True)
        if start is None or end is None:
            return None
        text = self.raw(left[start:]) + self.raw(right[:end])
        middle = self.plain(text.decode("utf-8"))
        if not left_whole and middle[0] != left[start] or not right_whole and middle[-1] != right[end - 1]:
            return None
        return start, middle, end

    def _sure(self, ids: np.ndarray, last: bool) -> int | None:
        """The first (or last) inner place between tokens that is a sure split."""
        parts = [self.bytes_of[i] for i in ids.tolist()]
        for k in range(len(parts) - 1, 0, -1) if last else range(1, len(parts)):
            # an ASCII byte that isn't blank: no part of a longer character, nor a blank of Unicode
            if parts[k][:1] in (b" ", b"\n") and 0x21 <= parts[k - 1][-1] <= 0x7E:
                return k
        return None

    def tree(self, leaves: list[np.ndarray]) -> np.ndarray:
        """Join neighbours level by level."""
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i : i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
        return leaves[0] if leaves else np.zeros(0, "<u4")


_codecs: dict[int, Codec] = {}


def _codec(vocab: Vocabulary) -> Codec:
    """One codec a Python worker."""
    key = hash(vocab)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(vocab)
    return _codecs[key]


def _digests(codec: Codec, ids: np.ndarray) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest()


def encode_documents(
    docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", split_over: int = SPLIT_OVER, leaf: int = LEAF, with_ids: bool = False, with_text: bool | None = None
) -> DataFrame:
    """One row a document: the number of ids and the digests of the ids and of the decoded text.

    With ``with_ids`` the ids themselves follow as an array, and (unless ``with_text`` is false) the decoded text.
    """
    with_text = with_ids if with_text is None else with_text
    vocab = read_vocabulary(vocabulary_path)
    shipped = docs.sparkSession.sparkContext.broadcast(vocab)
    slim = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded string" * with_text
    names = [c.split()[0] for c in out.split(", ")]

    def rows(codec: Codec, keys: pa.Array, coded: list[np.ndarray], names: list[str] = names) -> pa.RecordBatch:
        n, a, b = zip(*(_digests(codec, ids) for ids in coded)) if coded else ((), (), ())
        columns = [keys, pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
        if with_ids:
            columns.append(pa.array([x.astype("<i4") for x in coded], pa.list_(pa.int32())))
        if with_text:
            columns.append(pa.array([codec.decode(x) for x in coded], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names)

    def in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                yield rows(codec, part.column(0), [codec.encode(t) for t in part.column(1).to_pylist()])

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(shipped.value)
        special = codec.special_ids
        for b in batches:
            ids = [np.array([special[t]], "<u4") if s else codec.plain(t) for t, s in zip(b["piece"], b["special"])]
            yield b.drop(columns=["piece"]).assign(ids=[x.tobytes() for x in ids])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        codec = _codec(shipped.value)
        parts = []
        for _, section in pdf.sort_values(["section", "leaf"]).groupby("section", sort=True):
            parts.append(codec.tree([np.frombuffer(x, "<u4") for x in section["ids"]]))
        return rows(codec, pa.array(pdf["rid"].iloc[:1]), [np.concatenate(parts)], ["rid", *names[1:]]).to_pandas()

    size = F.char_length("text")
    short = slim.where(size <= split_over).mapInArrow(in_place, out)
    specials = "|".join(re.escape(s) for s, _ in sorted(vocab.specials, key=lambda x: -len(x[0]))) or "(?!)"
    # plain and special strings by turns, then leaves of the plain ones
    parts = F.split("text", f"(?={specials})|(?<={specials})")
    # a long text is known by its digest, which a task that is run again gives again; equal texts are encoded once
    keyed = slim.where(size > split_over).withColumn("rid", F.sha2("text", 256))
    texts = keyed.groupBy("rid").agg(F.first("text").alias("text"))
    sections = texts.select("rid", F.posexplode(parts).alias("section", "plain"))
    sections = sections.withColumn("special", F.col("plain").isin([s for s, _ in vocab.specials]))
    cut = F.when(F.col("special"), F.array("plain")).otherwise(F.regexp_extract_all("plain", F.lit(f"(?s).{{1,{leaf}}}"), F.lit(0)))
    pieces = sections.select("rid", "section", "special", F.posexplode(cut).alias("leaf", "piece"))
    coded = pieces.repartition("rid", "section", "leaf").mapInPandas(leaves, "rid string, section int, special boolean, leaf int, ids binary")
    encoded = coded.groupBy("rid").applyInPandas(joined, out.replace(f"doc_id {kind}", "rid string", 1))
    return short.unionByName(keyed.select("doc_id", "rid").join(encoded, "rid").select(*names))
