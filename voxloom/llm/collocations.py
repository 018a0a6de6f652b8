"""Phrase collocation mining: what words a language keeps together.

1. Words are counted by language; those with ``least`` occurrences or more are frequent.
2. A phrase can be frequent only where the phrases inside it are.  A scan explodes all phrases of two words that pass this
   test into rows (lang, phrase, count), which a hash aggregate by language sums up; one of three words follows, and
   one of all longer ones.
3. What is frequent at one size becomes a set of hashes in bits of bounded size (``bits``) for the scan of the next.
   The bits only leave phrases out that can't be frequent; all counts are of the words themselves.
4. Each candidate meets the counts of its first and last words at every cut in joins; the score is decimal
   arithmetic.  Candidates inside a one-word extension that occurs as often are dropped by an anti-join: an occurrence
   of a longer phrase is one of everything inside it, so if any longer candidate is as frequent, one of these is.
   A window ranks what is left, with only the best ``top`` of each task moving.

Counts are summed within tasks before they move, so that a word with a third of all occurrences is a
few rows.

Defined cases: a null text is empty; a null language is ``und``, together with one of that name; pieces without
words give nothing; words and phrases overlap freely ("a a a" holds "a a" twice); repeated rows count as often as
they occur, whatever their ids; texts are read whole, however long; ties in score rank by count, then by phrase
in byte order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bits import Bits, bits_of
from .common import materialize
from .syncmers import mix
from .words import BASE, coded, groups, summed, word_hasher, word_hashes

MOST_WORDS = 5
LEAST = 100
TOP = 2_000
#: Every mark that ends a piece becomes a line feed; tabs become blanks.
_MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


@dataclass
class Words:
    """The words of the texts of one language in order, with breaks between pieces."""

    lang: str
    words: pa.Array
    ids: np.ndarray  # place in ``words``; -1 for a break
    codes: np.ndarray  # 64-bit hashes of (lang, word); 0 for a break


def _split(raw: bytes) -> list[bytes]:
    return raw.split(b" ")


def coded_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for b in groups(batches):
        langs = b.column("lang").to_pylist()
        raws = [t.encode("utf-8").lower().translate(_MARKS).replace(b"\n", b" \n ") + b" \n" if t else b"" for t in b.column("text").to_pylist()]
        for lang in sorted(set(langs)):
            words, ids, _ = coded([r for r, own in zip(raws, langs) if own == lang and r], _split)
            codes = word_hashes(words, lang)
            nothing, ends = (words.index(pa.scalar(w, words.type)).as_py() for w in (b"", b"\n"))
            ids = ids[ids != nothing]
            if ends >= 0:
                codes[ends] = 0
            own = codes[ids]
            yield Words(lang, words, np.where(own == 0, -1, ids), own)


def phrases(codes: np.ndarray, known: list[Bits], n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places, hashes) of the phrases of 2 to ``n`` words of which all inner phrases may be frequent.

    ``known`` holds the frequent words, pairs and so on, as far as they are counted.
    """
    may = codes != 0
    may[may] = known[0].has(mix(codes[may]))
    own = codes
    for size in range(2, n + 1):
        at = np.flatnonzero(may[:-1] & may[1:])
        made = mix(own[at] * np.uint64(BASE) + codes[at + size - 1])
        if size <= len(known):
            keep = known[size - 1].has(made)
            at, made = at[keep], made[keep]
        yield size, at, made
        may = np.zeros(max(len(may) - 1, 0), bool)
        may[at] = True
        own = np.zeros(len(may), np.uint64)
        own[at] = made


def _count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, n); all words of a language together are a row without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in coded_pieces(batches):
            n = np.bincount(p.ids[p.ids >= 0], minlength=len(p.words))
            at = np.flatnonzero(n)
            if len(at):
                words = p.words.take(pa.array(at)).cast(pa.large_string()).cast(pa.string())
                columns = [pa.concat_arrays([words, pa.nulls(1, pa.string())]), pa.array(np.append(n[at], n.sum()))]
                yield pa.RecordBatch.from_arrays([pa.array([p.lang] * len(columns[0]), pa.string()), *columns], ["lang", "word", "n"])

    found = docs.mapInArrow(lambda batches: summed(run(batches), "n"), "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _explode(docs: DataFrame, known: list[Bits], sizes: range) -> DataFrame:
    """(lang, phrase, n) of all phrases of these sizes that may be frequent, summed over the texts of a task by their very words."""
    shipped = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in coded_pieces(batches):
            own = p.ids
            for size, at, _ in phrases(p.codes, shipped.value, sizes[-1]):
                if not len(at):
                    break
                # the number of the phrase without its last word, and the last word: no hash decides what is equal
                _, first, same, n = np.unique(own[at] * len(p.words) + p.ids[at + size - 1], return_index=True, return_inverse=True, return_counts=True)
                own = np.full(len(p.ids), -1)
                own[at] = same
                if size in sizes:
                    words = [p.words.take(pa.array(p.ids[at[first] + j])) for j in range(size)]
                    phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", p.words.type)).cast(pa.large_string()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([p.lang] * len(n), pa.string()), phrase, pa.array(n)], ["lang", "phrase", "n"])

    found = docs.mapInArrow(lambda batches: summed(run(batches), "n"), "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def phrase_codes(found: DataFrame) -> DataFrame:
    """(code): the hashes that ``phrases`` gives these phrases, made of the few that are frequent so that none travels with all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [p.encode("utf-8").split(b" ") for p in b.column("phrase").to_pylist()]
            hashers = {lang: word_hasher(lang) for lang in set(b.column("lang").to_pylist())}
            hashes = [list(map(hashers[lang], ws)) for lang, ws in zip(b.column("lang").to_pylist(), words)]
            sizes = np.array([len(h) for h in hashes])
            code = np.zeros(len(hashes), np.uint64)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                table = np.array([hashes[i] for i in at], np.uint64)
                own = table[:, 0]
                for j in range(1, size):
                    own = mix(own * np.uint64(BASE) + table[:, j])
                code[at] = own if size > 1 else mix(own)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64))], ["code"])

    return found.select("lang", "phrase").mapInArrow(run, "code long")


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of 1 to ``most_words`` words with ``least`` occurrences, and (lang, total) of all words."""
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words = materialize(_count_words(named).where((F.col("n") >= least) | F.col("word").isNull()), "words")
    size = F.size(F.split("phrase", " ", -1)).alias("size")
    found = words.where(F.col("word").isNotNull()).select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "n")
    known, last = [], found
    for sizes in (range(2, 3), range(3, 4), range(4, most_words + 1)):
        if sizes and sizes[0] <= most_words:
            known.append(bits_of(phrase_codes(last), "code"))
            last = materialize(_explode(named, known, sizes).where(F.col("n") >= least).select("lang", "phrase", size, "n"), "phrases")
            found = found.unionByName(last)
    return found, words.where(F.col("word").isNull()).select("lang", F.col("n").alias("total"))


def score_phrases(counted: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of phrases of two words or more, at the cut that scores least."""
    parts = F.split("phrase", " ", -1)
    cuts = counted.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.array_join(F.slice(parts, 1, F.col("k")), " ")).withColumn("rest", F.array_join(F.slice(parts, F.col("k") + 1, F.col("size") - F.col("k")), " "))
    known = counted.select("lang", "phrase", "n")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]).join(totals, "lang")
    a, total, left, right = (F.col(c).cast("decimal(16,0)") for c in ("a", "total", "l", "r"))
    # 4 + 16 + 16 digits and two carries: 38, whatever the counts
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * a * total, left * right)
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a", F.col("total").alias("n"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return scored.agg(best).select("lang", "phrase", "size", "a", "best.l", "best.r", "n", "best.score")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases that no longer one replaces."""
    counted, totals = count_phrases(docs, text, lang, least, most_words)
    longer = counted.where("size > 2").withColumn("words", F.split("phrase", " ", -1))
    inner = F.array(F.array_join(F.slice("words", 1, F.col("size") - 1), " "), F.array_join(F.slice("words", 2, F.col("size") - 1), " "))
    longer = longer.select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("a")).distinct()
    left = score_phrases(counted, totals).join(longer, ["lang", "phrase", "a"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = left.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
