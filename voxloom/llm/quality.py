"""Quality classification by a linear-chain conditional random field over lines.

Every line of a document is good or bad.  A line's evidence is its own shape (letter case, symbols,
digits, separators, repeated and doubled words, lengths) and that of its two neighbours; transition weights
tie the labels of neighbouring lines.  Forward-backward gives each line's probability of being
good, and the document's score is their mean weighted by length.

The labels are of documents; those of lines stay latent.  After a start from lines that take their
document's label, rounds of posterior regularisation follow: the lines' labels are those that the
model expects, moved no further than it takes for the length-weighted good share of a good document to be
``SURE`` or more and of a bad one ``1 - SURE`` or less; then the weights are fitted to them.  So a
half-good document may have good lines and bad ones, and the transitions see both.  The fit reads at
most ``MAX_SAMPLE`` labelled documents of at most ``MAX_LINES`` lines together and a hundredth of that each (a bounded, documented sample)
and sees only their text; key, language and source are never inputs.  Scoring reads every line of every
document.

Defined cases: a null or empty text is one empty line; without labelled documents of both kinds
every document gets the share of good ones in the sample (0.5 without any); repeated rows repeat;
null keys stay null and are never drawn for fitting; texts of any length and number of lines are scored
whole, long chains in blocks; an empty table gives no rows; other columns are not read (the filter passes
them through).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, small_parts
from .labelled import labelled_sample, within

MAX_SAMPLE = 4_000
MAX_LINES = 200_000
#: Least good share of a good document, and most of a bad one, in fitting.
SURE = 0.97
#: Rounds of latent labels after the start, and gradient steps of each.
ROUNDS, STEPS = 3, 40
#: Bytes of text whose lines are measured at once, and lines whose words are.
CHUNK, LINES = 4 << 20, 50_000
#: Lines of a document from which its chain is worked in blocks.
LONG = 512

_SYMBOLS = b"#$%&*+<=>@^_`{}~\\[]"
_CLASSES = ("upper", "lower", "digit", "blank", "symbol", "bar", "bang", "stop", "high")
#: Cuts that turn each measure of a line into a step code.
_CUTS = {
    "upper": (0.08, 0.2, 0.5),
    "digit": (0.02, 0.1, 0.3),
    "symbol": (0.01, 0.05, 0.15),
    "bar": (0.005, 0.03),
    "bang": (0.005, 0.05),
    "stop": (0.004, 0.02, 0.05),
    "high": (0.02, 0.1),
    "word": (3.0, 5.0, 7.0, 9.0),
    "distinct": (0.3, 0.6, 0.8, 0.95),
    "repeat": (0.03, 0.15, 0.4),
    "size": (2.0, 3.5, 5.0, 6.5),
}
N_STEPS = sum(map(len, _CUTS.values()))
N_FEATURES = 3 * N_STEPS + 3


def _class_table() -> np.ndarray:
    table = np.full(256, 255, dtype=np.uint8)
    for k, members in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 10, 13, 32), _SYMBOLS, b"|", b"!?", b".,;:", range(128, 256))):
        table[list(members)] = k
    return table


_TABLE = _class_table()


def _line_blocks(raws: list[bytes]) -> Iterator[bytes]:
    """All lines of the texts in order, as blocks of whole lines of about ``CHUNK`` bytes; a longer line is a block."""
    held, n = [], 0
    for raw in raws:
        at = 0
        while len(raw) - at > CHUNK:
            cut = raw.find(b"\n", at + CHUNK)
            if cut < 0:
                break
            yield b"\n".join([*held, raw[at:cut]])
            held, n, at = [], 0, cut + 1
        held.append(raw[at:] if at else raw)
        n += len(raw) - at
        if n > CHUNK:
            yield b"\n".join(held)
            held, n = [], 0
    if held:
        yield b"\n".join(held)


def _measure_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    joined = np.frombuffer(block + b"\n", np.uint8)
    lines = block.split(b"\n")
    ends = np.flatnonzero(joined == 10)
    starts = np.append(0, ends[:-1] + 1)
    size = (ends - starts).astype(float)
    kinds = _TABLE[joined]
    share = {}
    for k, name in enumerate(_CLASSES):
        if name in _CUTS:
            share[name] = np.add.reduceat((kinds == k).view(np.uint8), starts, dtype=np.int64) / np.maximum(size, 1)
    n_words, n_distinct, n_doubled = (np.empty(len(lines)) for _ in range(3))
    for at in range(0, len(lines), LINES):  # the words of so many lines at a time
        split = [line.split() for line in lines[at : at + LINES]]
        here = slice(at, at + len(split))
        n_words[here], n_distinct[here] = list(map(len, split)), [len(set(w)) for w in split]
        n_doubled[here] = [sum(map(eq, w, w[1:])) for w in split]
    share["repeat"] = n_doubled / np.maximum(n_words, 1)
    share["word"] = size / np.maximum(n_words, 1)
    share["distinct"] = np.where(n_words > 0, n_distinct / np.maximum(n_words, 1), 1.0)
    share["size"] = np.log1p(size)
    return np.stack([share[name] > cut for name, cuts in _CUTS.items() for cut in cuts], axis=1), size


def measure(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step codes of every line, lengths of the lines, and the number of lines of each text.

    Lines are measured in blocks, so that what a text needs is its step codes and one block's words.
    """
    raw = [t.encode("utf-8") for t in texts]
    n_lines = np.array([r.count(b"\n") + 1 for r in raw], dtype=np.int64)
    steps, sizes = zip(*map(_measure_block, _line_blocks(raw)))
    return np.concatenate(steps), np.concatenate(sizes), n_lines


def features(steps: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """A line's own steps and its neighbours', with marks for a first and a last line."""
    out = np.zeros((len(steps), N_FEATURES), dtype=np.float32)
    last = np.cumsum(n_lines) - 1
    first = last - n_lines + 1
    out[:, :N_STEPS] = steps
    out[1:, N_STEPS : 2 * N_STEPS] = steps[:-1]
    out[:-1, 2 * N_STEPS : 3 * N_STEPS] = steps[1:]
    out[first, N_STEPS : 2 * N_STEPS] = 0
    out[last, 2 * N_STEPS : 3 * N_STEPS] = 0
    out[first, -3] = 1
    out[last, -2] = 1
    out[:, -1] = 1
    return out


@dataclass
class ChainModel:
    """Weights of the good label's evidence and the 2 x 2 transition scores (bad, good)."""

    weights: np.ndarray
    transitions: np.ndarray
    constant: float | None = None


def marginals(evidence: np.ndarray, n_lines: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of every line, expected transition counts, and the log of all partition functions.

    All documents advance together, the longest first, so that each step is one array operation.
    """
    order = np.argsort(-n_lines, kind="stable")
    counts, first = n_lines[order], (np.cumsum(n_lines) - n_lines)[order]
    active = np.searchsorted(-counts, -np.arange(counts[0]), "left")  # documents with more than t lines
    good = np.exp(np.clip(evidence, -30, 30))
    psi = np.exp(transitions)
    a = np.zeros((len(evidence), 2))
    scale = np.zeros(len(evidence))
    for t, d in enumerate(active):
        at = first[:d] + t
        v = np.ones((d, 2)) if t == 0 else a[at - 1] @ psi
        v[:, 1] *= good[at]
        scale[at] = v.sum(axis=1)
        a[at] = v / scale[at, None]
    b = np.ones((len(evidence), 2))
    pairs = np.zeros((2, 2))
    for t in range(len(active) - 2, -1, -1):
        d = active[t + 1]
        at = first[:d] + t
        ahead = b[at + 1].copy()
        ahead[:, 1] *= good[at + 1]
        ahead /= scale[at + 1, None]
        b[at] = ahead @ psi.T
        pairs += psi * (a[at].T @ ahead)
    p = a * b
    return p[:, 1] / p.sum(axis=1), pairs, float(np.log(scale).sum())


def line_evidence(weights: np.ndarray, steps: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """``features(steps, n_lines) @ weights`` without the table of features."""
    own, before, after = (weights[k * N_STEPS : (k + 1) * N_STEPS] for k in range(3))
    three = np.concatenate([steps[a : a + LINES].astype(np.float32) @ np.stack([own, before, after], axis=1) for a in range(0, len(steps), LINES)])
    last = np.cumsum(n_lines) - 1
    first = last - n_lines + 1
    out = three[:, 0] + weights[-1]
    left, right = np.append(0, three[:-1, 1]), np.append(three[1:, 2], 0)
    left[first], right[last] = weights[-3], weights[-2]
    return out + left + right


def chain_marginals(evidence: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """P(good) of every line of one long document.

    A message passes a line as a product with a 2 x 2 matrix.  The products within blocks of about
    sqrt(n) lines are taken for all blocks at once, then messages pass from block to block.
    """
    n = len(evidence)
    size = int(np.ceil(np.sqrt(n)))
    good = np.exp(np.clip(evidence, -30, 30))
    emit = np.stack([np.ones(n), good], axis=1)
    step = np.tile(np.eye(2), (-(-n // size) * size, 1, 1))
    step[:n] = np.exp(transitions)[None] * emit[:, None, :]
    step[0] = emit[0]
    step = step.reshape(-1, size, 2, 2)
    upto = step.copy()  # product of the block's first lines up to each
    for k in range(1, size):
        upto[:, k] = upto[:, k - 1] @ step[:, k]
        upto[:, k] /= upto[:, k].max(axis=(1, 2), keepdims=True)
    after = np.tile(np.eye(2), (*step.shape[:2], 1, 1))  # product of the lines behind each in its block
    for k in range(size - 2, -1, -1):
        after[:, k] = step[:, k + 1] @ after[:, k + 1]
        after[:, k] /= after[:, k].max(axis=(1, 2), keepdims=True)
    enter, leave = np.ones((len(step), 2)), np.ones((len(step), 2))
    for b in range(1, len(step)):
        v = enter[b - 1] @ upto[b - 1, -1]
        enter[b] = v / v.sum()
    for b in range(len(step) - 2, -1, -1):
        v = upto[b + 1, -1] @ leave[b + 1]
        leave[b] = v / v.sum()
    a = np.einsum("bi,bkij->bkj", enter, upto).reshape(-1, 2)[:n]
    z = np.einsum("bkij,bj->bki", after, leave).reshape(-1, 2)[:n]
    a /= a.sum(axis=1, keepdims=True)
    p = a * z / z.sum(axis=1, keepdims=True)
    return p[:, 1] / p.sum(axis=1)


def line_probabilities(model: ChainModel, steps: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """P(good) of every line of the documents."""
    e = line_evidence(model.weights, steps, n_lines)
    p = np.empty(len(e))
    long = np.repeat(n_lines > LONG, n_lines)
    if not long.all():
        p[~long] = marginals(e[~long], n_lines[n_lines <= LONG], model.transitions)[0]
    ends = np.cumsum(n_lines)
    for d in np.flatnonzero(n_lines > LONG):
        p[ends[d] - n_lines[d] : ends[d]] = chain_marginals(e[ends[d] - n_lines[d] : ends[d]], model.transitions)
    return p


def document_scores(model: ChainModel, texts: list[str]) -> np.ndarray:
    """Length-weighted mean probability of the lines of each text."""
    out = np.empty(len(texts))
    if model.constant is not None:
        out[:] = model.constant
        return out
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= CHUNK):
            size, to = size + len(texts[to]), to + 1
        steps, length, n_lines = measure(texts[at:to])
        p = line_probabilities(model, steps, n_lines)
        starts = np.cumsum(n_lines) - n_lines
        weight = length + 1
        out[at:to] = np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts)
        at = to
    return np.clip(out, 0.0, 1.0)


def latent_labels(evidence: np.ndarray, n_lines: np.ndarray, transitions: np.ndarray, weight: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected line labels and transition counts nearest to the model's that agree with the documents' labels.

    The nearest distribution tilts each line's evidence in proportion to its share of the document's
    length; the tilt of each document is found by bisection (none where the model agrees already).
    """
    doc = np.repeat(np.arange(len(n_lines)), n_lines)
    starts = np.cumsum(n_lines) - n_lines
    share = weight / np.add.reduceat(weight, starts)[doc]
    sign = np.where(labels > 0, 1.0, -1.0)
    tilt = share * n_lines[doc] * sign[doc]  # a tilt of 1 moves an average line by 1

    def agree(by: np.ndarray) -> np.ndarray:
        p, _, _ = marginals(evidence + by[doc] * tilt, n_lines, transitions)
        s = np.add.reduceat(p * share, starts)
        return np.where(labels > 0, s, 1 - s) >= SURE

    low, high = np.zeros(len(n_lines)), np.full(len(n_lines), 60.0)
    high[agree(low)] = 0.0
    for _ in range(12):
        mid = (low + high) / 2
        ok = agree(mid)
        low, high = np.where(ok, low, mid), np.where(ok, mid, high)
    p, pairs, _ = marginals(evidence + high[doc] * tilt, n_lines, transitions)
    return p, pairs


def fit_chain(x: np.ndarray, n_lines: np.ndarray, labels: np.ndarray, weight: np.ndarray | None = None, l2: float = 2e-4, rate: float = 0.08) -> ChainModel:
    """Conditional likelihood by full-batch Adam, of the documents' labels on their lines first, of latent labels then."""
    weight = np.ones(len(x)) if weight is None else weight
    inner = n_lines - 1
    y = np.repeat(labels, n_lines).astype(float)
    seen = np.array([[((labels == 0) * inner).sum(), 0], [0, ((labels == 1) * inner).sum()]], dtype=float)
    total = float(n_lines.sum())
    w, trans = np.zeros(x.shape[1], np.float32), np.zeros((2, 2))
    for turn in range(1 + ROUNDS):
        if turn:
            y, seen = latent_labels(x @ w, n_lines, trans, weight, labels)
        m1, m2, t1, t2 = np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)
        for k in range(1, STEPS * (1 if turn else 3) + 1):
            p, pairs, _ = marginals(x @ w, n_lines, trans)
            g = x.T @ (p - y).astype(np.float32) / total + l2 * w
            gt = (pairs - seen) / total + 20 * l2 * trans
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
            t1, t2 = 0.9 * t1 + 0.1 * gt, 0.99 * t2 + 0.01 * gt * gt
            w = w - rate * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-7)
            trans = trans - rate * (t1 / (1 - 0.9**k)) / (np.sqrt(t2 / (1 - 0.99**k)) + 1e-7)
    return ChainModel(w, trans)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, key: str = "doc_id", text: str = "text", most: int = MAX_SAMPLE) -> ChainModel:
    """A model from a bounded sample of the labelled documents (those that ``allowed`` admits)."""
    drawn = labelled_sample(docs, labels, "quality", most, allowed, key, text)
    sample = within(drawn, F.regexp_count("text", F.lit("\n")) + 1, MAX_LINES)  # of both classes, if there are

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            for t, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                steps, size, n = measure([t])
                packed = np.packbits(steps, axis=None).tobytes()
                columns = [pa.array([y], pa.int32()), pa.array(n), pa.array([packed], pa.binary()), pa.array([size.astype("<i8").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["label", "n_lines", "steps", "sizes"])

    rows = sample.mapInArrow(measured, "label int, n_lines long, steps binary, sizes binary").collect()  # at most MAX_LINES lines
    discard(drawn)
    y = np.array([min(max(r.label, 0), 1) for r in rows])
    if len(set(y.tolist())) < 2:
        return ChainModel(np.zeros(N_FEATURES, np.float32), np.zeros((2, 2)), float(y.mean()) if len(y) else 0.5)
    n_lines = np.array([r.n_lines for r in rows])
    steps = np.concatenate([np.unpackbits(np.frombuffer(r.steps, np.uint8), count=r.n_lines * N_STEPS).reshape(-1, N_STEPS) for r in rows])
    weight = np.concatenate([np.frombuffer(r.sizes, "<i8") for r in rows]) + 1.0
    return fit_chain(features(steps, n_lines), n_lines, y, weight)


def score(docs: DataFrame, model: ChainModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score and predicted label of every document."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            s = document_scores(shipped.value, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype("i4"))], ["doc_id", "score", "predicted"])

    return slim.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def drop_bad(docs: DataFrame, model: ChainModel, text: str = "text") -> DataFrame:
    """The documents whose score is 0.5 or more, with all their columns."""
    at, shipped = docs.columns.index(text), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            s = document_scores(shipped.value, [t or "" for t in b.column(at).to_pylist()])
            yield b.filter(pa.array(s >= 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
