"""Token counts by the whole-token shortcut.

Offline, on the driver, ``prove_whole_tokens`` finds the vocabulary strings that the pattern
keeps in one piece and whose own merges end in one token.  Such a piece of a text is one token
whatever stands around it, as merges never cross pieces.  Tasks count these pieces by lookup and
merge only the remaining pieces, each distinct one once while a bounded memo holds it.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); special strings inside a text
are one token each, as the tokenizer takes them by default; texts of any length are counted whole
and one at a time; repeated rows repeat in the result; a null doc_id stays null; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PATTERN, Vocabulary, byte_letters, encoder, read_vocabulary, special_splitter

#: Distinct merged pieces that a task remembers before it starts anew.
MEMO = 200_000

#: Code points whose letter, number and space classes every Unicode version of the last decade
#: agrees on; a text with others is split by the tokenizer's own pre-tokenizer.
_AGREED = r"\x00-ԯ‐-⁤ぁ-ゖァ-ヺ一-龥가-힣"


@lru_cache(maxsize=4)
def prove_whole_tokens(vocab: Vocabulary) -> frozenset[str]:
    """The vocabulary strings that encode alone as one token and that splitting leaves whole."""
    import regex

    split, enc = regex.compile(PATTERN), encoder(vocab)
    agreed = regex.compile(f"[{_AGREED}]+")
    proven = set()
    for i, raw in enumerate(vocab.tokens):
        try:
            s = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if agreed.fullmatch(s) and split.findall(s) == [s] and enc.encode_ordinary(s) == [i]:
            proven.add(s)
    return frozenset(proven)


class _Merged(dict):
    """Token counts of pieces: the proven ones from the start, others merged when first met."""

    def __init__(self, proven: frozenset[str], encode):
        super().__init__(dict.fromkeys(proven, 1))
        self.proven, self.encode, self.most = proven, encode, len(proven) + MEMO

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update(dict.fromkeys(self.proven, 1))
        n = self[piece] = len(self.encode(piece))
        return n


class _Counter:
    def __init__(self, vocab: Vocabulary, proven: frozenset[str]):
        import regex
        from tokenizers.pre_tokenizers import ByteLevel

        enc = encoder(vocab)
        self.pieces = regex.compile(PATTERN).findall
        self.odd = regex.compile(f"[^{_AGREED}]").search
        self.counts = _Merged(proven, enc.encode_ordinary)
        self.specials = special_splitter(vocab)
        self.own, self.letters = ByteLevel(add_prefix_space=False, use_regex=True), byte_letters()

    def section(self, text: str) -> int:
        if self.odd(text):
            raw = (bytes(self.letters[c] for c in p).decode("utf-8") for p, _ in self.own.pre_tokenize_str(text))
            return sum(map(self.counts.__getitem__, raw))
        return sum(map(self.counts.__getitem__, self.pieces(text)))

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if not self.specials:
            return self.section(text)
        parts = self.specials.split(text)
        return len(parts) // 2 + sum(map(self.section, parts[::2]))


@lru_cache(maxsize=2)
def _counter(vocab: Vocabulary, proven: frozenset[str]) -> _Counter:
    return _Counter(vocab, proven)


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: UTF-8 bytes, tokens, and whether the tokens exceed ``limit``."""
    vocab = read_vocabulary(vocabulary_path)
    shipped = docs.sparkSession.sparkContext.broadcast((vocab, prove_whole_tokens(vocab)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*shipped.value)
        for b in batches:
            n = [counter(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
