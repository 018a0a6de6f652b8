"""Toxicity by cumulative-link ordinal regression.

Severity has the ordered grades 0 (none) to 3.  One weight for each word is shared by all
thresholds: ``P(grade >= j) = sigmoid(w . x - t_j)`` with ``t_1 < t_2 < t_3`` and x the presence of
words and the number of distinct words with a given beginning.  The expected severity is the sum of the three probabilities, and a document is toxic
where grade 1 or more is likelier than not.

The labels hold one bit, so the grades above 0 are latent and estimated without the document's own
label or weights that have seen it: the sample is cut into ``FOLDS`` by a hash, a model of two grades is
fitted without each fold in turn, and the toxic documents of the fold get grade 1, 2 or 3 by the third in which
their evidence lies among the toxic documents.  The first threshold is thus learnt from the labels, the
other two from that order.  The fit takes at most ``MAX_SAMPLE`` labelled documents with at most ``MAX_CELLS``
features together and the ``MAX_WORDS`` features most associated with the label, all bounded by parameter;
scoring reads every word of every document.

Defined cases: a null text is empty; without labelled documents of both kinds the model gives every
document the same severity, that of the sample (0 without any); repeated rows repeat; null keys stay
null; texts of any length are read whole, their distinct words held one text at a time; an empty table
gives no rows; other columns are not read (the filter passes them through).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, small_parts
from .labelled import labelled_sample, within

MAX_SAMPLE = 20_000
MAX_WORDS = 4_000
#: Features of the sample's documents that the fit holds.
MAX_CELLS = 8_000_000
GRADES = 3
FOLDS = 2
#: Least documents of the sample that a word must be in.
LEAST_DOCS = 3
#: Distinct words whose weights a task remembers before it starts anew.
MEMO = 100_000

_WORD = re.compile(r"[^\W\d_]+")


#: Lengths of the word beginnings that are features besides the words, for inflected and compound forms.
STEMS = (5, 7)


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def word_features(word: str) -> list[str]:
    """The word and its beginnings; a document has each as often as distinct words have it."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (30.0, 31.0, 32.0)

    def probabilities(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= j) in column j - 1."""
        return 1 / (1 + np.exp(-np.clip(eta[:, None] - np.array(self.thresholds), -35, 35)))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, n_features: int, l2: float = 4e-4, steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by full-batch Adam on the ordinal likelihood.

    Thresholds are kept in order by fitting the first and the logarithms of the steps between.
    """
    n = len(rows)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    feature = np.fromiter((f for r in rows for f in r), np.int64, len(owner))
    p = np.zeros(n_features + GRADES)
    share = [max(1e-3, float((grades >= j).mean())) for j in range(1, GRADES + 1)]
    p[n_features] = -np.log(share[0] / (1 - min(share[0], 0.999)))
    mean, square = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, gaps = p[:n_features], np.exp(p[n_features + 1 :])
        t = p[n_features] + np.append(0, np.cumsum(gaps))
        eta = np.bincount(owner, w[feature], n)
        above = 1 / (1 + np.exp(-np.clip(eta[:, None] - t, -35, 35)))  # P(grade >= j)
        wall = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        slope = np.hstack([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))])
        at = np.arange(n)
        mass = np.maximum(wall[at, grades] - wall[at, grades + 1], 1e-12)
        d_low, d_high = slope[at, grades] / mass, slope[at, grades + 1] / mass
        g_eta = -(d_low - d_high) / n
        g_t = np.array([(np.where(grades == j, d_low, 0) - np.where(grades == j - 1, d_high, 0)).sum() / n for j in range(1, GRADES + 1)])
        g = np.empty_like(p)
        g[:n_features] = np.bincount(feature, g_eta[owner], n_features) + l2 * w
        g[n_features] = g_t.sum()
        for j in range(1, GRADES):
            g[n_features + j] = g_t[j:].sum() * gaps[j - 1]
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        p -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        p[n_features + 1 :] = np.clip(p[n_features + 1 :], -6, 6)
    return p[:n_features], p[n_features] + np.append(0, np.cumsum(np.exp(p[n_features + 1 :])))


def latent_grades(rows: list[list[int]], toxic: np.ndarray, fold: np.ndarray, n_features: int) -> np.ndarray:
    """Grades of the documents: 0 where clean, else by thirds of evidence from models that haven't seen them."""
    grades = toxic.copy()
    for k in range(FOLDS):
        own = np.flatnonzero((fold == k) & (toxic > 0))
        rest = np.flatnonzero(fold != k)
        if len(own) < GRADES or len(set(toxic[rest].tolist())) < 2:
            continue  # too few to order: all stay at grade 1
        w, _ = fit_ordinal([rows[i] for i in rest], toxic[rest], n_features, steps=150)
        eta = np.array([w[rows[i]].sum() for i in own])
        cuts = np.quantile(eta, [j / GRADES for j in range(1, GRADES)])
        grades[own] = 1 + (eta[:, None] > cuts).sum(axis=1)
    return grades


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most: int = MAX_SAMPLE) -> OrdinalModel:
    """A model from a bounded sample of the labelled documents."""
    sample = labelled_sample(docs, labels, "toxic", most, key=key, text=text)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            for t, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                found = sorted({f for w in words(t) for f in word_features(w)})
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], ["word", "label"])

    sizes = dict(sample.groupBy((F.col("label") > 0).cast("int").alias("toxic")).count().collect())
    n_bad, n_good = sizes.get(1, 0), sizes.get(0, 0)
    if not n_bad or not n_good:
        discard(sample)
        return OrdinalModel(thresholds=(-30.0, 30.0, 31.0) if n_bad else (30.0, 31.0, 32.0))
    counted = sample.mapInArrow(distinct, "word string, label int").groupBy("word")
    counted = counted.agg(F.sum((F.col("label") > 0).cast("long")).alias("bad"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_DOCS)
    # log-odds of the word in toxic against clean documents, over its standard error
    odds = F.log((F.col("bad") + 0.5) / (F.col("n") - F.col("bad") + 0.5)) - float(np.log((n_bad + 0.5) / (n_good + 0.5)))
    z = odds / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("n") - F.col("bad") + 0.5))
    table = counted.select("word", z.alias("z")).orderBy(F.abs("z").desc(), "word").limit(MAX_WORDS).collect()
    number = {r.word: i for i, r in enumerate(table)}
    shipped = docs.sparkSession.sparkContext.broadcast(number)

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = shipped.value
        for b in small_parts(batches):
            rows = [sorted(have[f] for w in words(t) for f in word_features(w) if f in have) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "label", "features"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    featured = materialize(sample.select("doc_id", "label", "text").mapInArrow(featurize, f"doc_id {kind}, label int, features array<int>"), "features")
    fitted = within(featured, F.size("features").cast("long"), MAX_CELLS).orderBy("doc_id").select("label", "features", F.pmod(F.xxhash64("doc_id"), FOLDS).alias("fold")).collect()  # bounded by the sample and MAX_CELLS
    discard(featured), discard(sample)
    rows = [list(r.features) for r in fitted]
    grades = latent_grades(rows, np.array([int(r.label > 0) for r in fitted]), np.array([r.fold for r in fitted]), len(number))
    w, t = fit_ordinal(rows, grades, len(number))
    return OrdinalModel({r.word: float(w[i]) for i, r in enumerate(table)}, tuple(map(float, t)))


class _Weights(dict):
    """Total weight of each word met, with its beginnings; so many are remembered at most."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO:
            self.clear()
        w = self[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
        return w


def _etas(memo: _Weights, texts: list) -> np.ndarray:
    return np.array([sum(map(memo.__getitem__, words(t))) if t else 0.0 for t in texts], dtype=float)


def score(docs: DataFrame, model: OrdinalModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Expected severity, the probabilities behind it, the likeliest grade and the verdict."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(f"p{j}" for j in range(1, GRADES + 1)), "expected_severity", "grade", "toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        memo = _Weights(m.weights)
        for b in small_parts(batches):
            p = m.probabilities(_etas(memo, b.column("text").to_pylist()))
            grade = (p >= 0.5).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, p.T), pa.array(p.sum(axis=1)), pa.array(grade.astype("i4")), pa.array(grade > 0)], names)

    return slim.mapInArrow(run, f"doc_id {kind}, p1 double, p2 double, p3 double, expected_severity double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The documents that aren't toxic, with all their columns."""
    at, shipped = docs.columns.index(text), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        memo = _Weights(m.weights)
        for b in small_parts(batches):
            p = m.probabilities(_etas(memo, b.column(at).to_pylist()))
            yield b.filter(pa.array(p[:, 0] < 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
