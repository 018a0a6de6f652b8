"""Source divergence audit: how the word use of sources within a language differs.

1. One scan counts documents and occurrences of every term by language and source, summed within tasks before they
   move.  Terms in ``least_docs`` or more documents of the language are kept; a join leaves their counts.
2. Kept terms are dealt by hash into blocks, sources into groups.  A tile is the dense int64 matrix of a
   language's sources by the terms of one block, filled with what a term that doesn't occur is worth.
3. Each tile compares all pairs of its sources by broadcasting and gives a matrix of partial sums, and for
   every source a heap of its ``top`` terms.  Partial matrices are summed, heaps merged.

The shares p = 1 + floor(scale * (count + 5) / (N + 5 * V)) are decimal arithmetic before they reach a tile,
so that every figure is exact.  A tile holds about ``TERMS`` terms by at most two groups of about ``SOURCES``
sources, whatever the corpus.  All rows of a term, block or source are pre-aggregated before they move.

Defined cases: null text, lang or source is the empty string; a document without terms still makes its
source occur; a language without kept terms has pairs of value 0 and no ``term`` rows; a source alone in its
language has no pairs; repeated rows count as often as they occur, whatever their ids; texts are read whole,
however long; equal values rank by item in byte order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize
from .words import coded, groups

LEAST_DOCS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TOP = 50
#: Terms of a block and sources of a group, on average.
TERMS, SOURCES = 4_096, 128
#: Numbers that one broadcast comparison holds.
CELLS = 1 << 22

#: Terms are runs of ASCII letters and of bytes of other letters and signs; the rest parts them.
_LETTERS = bytes(c if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)).lower()


def _terms(b: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(dictionary, place in it of each term, row of each term)."""
    raws = [t.encode("utf-8").translate(_LETTERS) if t else b"" for t in b.column("text").to_pylist()]
    words, ids, sizes = coded(raws)
    return words, ids, np.repeat(np.arange(len(raws)), sizes)


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, count): documents that hold the term and its occurrences, summed over groups of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches):
            words, ids, rows = _terms(b)
            size = max(len(words), 1)
            langs, sources = b.column("lang").dictionary_encode(), b.column("source").dictionary_encode()
            lang, source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (langs, sources))
            n_sources = max(len(sources.dictionary), 1)
            # occurrences by row, then by group of rows
            own, n = np.unique(rows * size + ids, return_counts=True)
            key, at = np.unique((lang * n_sources + source)[own // size] * size + own % size, return_inverse=True)
            of, place = key // size, key % size
            columns = [
                langs.dictionary.take(pa.array(of // n_sources)),
                sources.dictionary.take(pa.array(of % n_sources)),
                words.take(pa.array(place)).cast(pa.large_string()).cast(pa.string()),
                pa.array(np.bincount(at, minlength=len(key))),
                pa.array(np.bincount(at, n, len(key)).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "docs", "count"])

    found = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, docs long, count long")
    return found.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))


def _share(count: Column, total: Column, n_terms: Column, scale: int) -> Column:
    """1 + floor(scale * (count + 5) / (total + 5 * V)), in decimals of 38 digits."""
    exact = [c.cast("decimal(19,0)") for c in (count + SMOOTH, total + SMOOTH * n_terms)]
    return F.call_function("div", F.lit(scale).cast("decimal(18,0)") * exact[0], exact[1]) + 1


def pair_sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums over the columns of abs(a[i] - b[j]) for all pairs of rows."""
    out = np.zeros((len(a), len(b)), np.int64)
    step = max(1, CELLS // max(1, a.shape[1] * len(b)))
    for at in range(0, len(a), step):
        out[at : at + step] = np.abs(a[at : at + step, None, :] - b[None, :, :]).sum(axis=2)
    return out


def _tile(pdf: pd.DataFrame, top: int) -> pd.DataFrame:
    """Partial sums of all pairs of the tile's sources, and the best terms of each source."""
    heads = pdf[pdf["term"].isna()].drop_duplicates("source")
    cells = pdf[pdf["term"].notna()]
    row = pd.Index(heads["source"]).get_indexer(cells["source"])
    column, terms = pd.factorize(cells["term"])
    dense = np.repeat(heads["p"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    dense[row, column] = cells["p"].to_numpy(np.int64)
    names, group = heads["source"].to_numpy(object), heads["grp"].to_numpy()
    i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    left, right = np.flatnonzero(group == i), np.flatnonzero(group == j)
    sums = pair_sums(dense[left], dense[right])
    if len(heads):  # terms of the block that occur in other groups of sources only
        absent = heads["p"].to_numpy(np.int64)
        sums += (int(heads["n_terms"].iloc[0]) - len(terms)) * np.abs(absent[left, None] - absent[None, right])
    x, y = np.nonzero(left[:, None] != right[None, :])
    pairs = pd.DataFrame({"source": names[left[x]], "item": names[right[y]], "value": sums[x, y]})
    if i != j:
        pairs = pd.concat([pairs, pairs.rename(columns={"source": "item", "item": "source"})])
    pairs["part"] = "pair"
    out = [pairs]
    if i == j:  # heaps of the group's sources, once
        best = cells.assign(value=cells["p"] - cells["q"])
        best = best[best["value"] > 0].assign(key=lambda d: d["term"].str.encode("utf-8"))
        best = best.sort_values(["value", "key"], ascending=[False, True], kind="stable").groupby("source").head(top)
        out.append(pd.DataFrame({"source": best["source"], "item": best["term"], "value": best["value"], "part": "term"}))
    found = pd.concat(out)
    found["lang"] = pdf["lang"].iloc[0]
    return found[["lang", "source", "part", "item", "value"]]


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    scale: int = SCALE,
    top: int = TOP,
    block_terms: int = TERMS,
    group_sources: int = SOURCES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` compares a source with every other of its language,
    part ``term`` lists the terms that it uses most above the language's share."""
    blank = F.lit("")
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), blank).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    counted = materialize(_counts(named), "counted")
    kept = materialize(counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("all")).where(F.col("docs") >= least_docs).drop("docs"), "terms")
    # a term comes with its count in the language
    cells = materialize(counted.drop("docs").join(kept, ["lang", "term"]), "cells")
    discard(counted)

    n_terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    n_tokens = cells.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    occurring = materialize(named.select("lang", "source").distinct(), "sources")
    sizes = occurring.join(n_tokens, ["lang", "source"], "left").join(n_terms, "lang", "left").fillna(0, ["n", "v"])
    sizes = materialize(sizes.withColumn("n_lang", F.sum("n").over(Window.partitionBy("lang"))), "sizes")
    biggest = sizes.groupBy("lang").agg(F.max("v").alias("v"), F.count(F.lit(1)).alias("g")).agg(F.max("v").alias("v"), F.max("g").alias("g")).first()
    n_blocks = max(1, -(-(biggest.v or 0) // block_terms))
    n_groups = max(1, -(-(biggest.g or 0) // group_sources))

    # the dense matrix needs every source of a block's language: one head a source and block, with the share of an absent term
    none = F.when(F.col("v") > 0, _share(F.lit(0), F.col("n"), F.col("v"), scale)).otherwise(F.lit(0))
    heads = sizes.select("lang", "source", F.lit(None).cast("string").alias("term"), none.alias("p"), F.lit(0).cast("long").alias("q"))
    block = F.pmod(F.xxhash64("term"), F.lit(n_blocks)).cast("int").alias("block")
    in_block = kept.groupBy("lang", block).agg(F.count(F.lit(1)).alias("n_terms"))
    heads = heads.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(in_block, ["lang", "block"], "left").fillna(0, ["n_terms"])
    full = cells.join(sizes, ["lang", "source"])
    shares = full.select(
        "lang",
        "source",
        "term",
        _share(F.col("count"), F.col("n"), F.col("v"), scale).alias("p"),
        _share(F.col("all"), F.col("n_lang"), F.col("v"), scale).alias("q"),
        block,
    )
    rows = heads.unionByName(shares, allowMissingColumns=True).withColumn("grp", F.pmod(F.xxhash64("source"), F.lit(n_groups)).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    rows = rows.withColumns({"i": F.least("grp", "other"), "j": F.greatest("grp", "other")}).drop("other")
    tiles = rows.groupBy("lang", "block", "i", "j").applyInPandas(lambda pdf: _tile(pdf, top), "lang string, source string, part string, item string, value long")
    tiles = materialize(tiles, "tiles")

    pairs = tiles.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    ranked = pairs.select(*columns, rank)
    merged = tiles.where("part = 'term'").select(*columns, rank).where(F.col("rank") <= top)
    discard(cells), discard(kept), discard(occurring), discard(sizes)
    return ranked.unionByName(merged)
