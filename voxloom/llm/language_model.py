"""Language-model scoring by a hashed maximum-entropy model with class-factored softmax.

``p(w | h) = p(class(w) | h) * p(output(w) | class(w), h) * p(w | output(w))``.  A word's class follows
from its ending, hashed into ``N_ENDINGS``; the endings are clustered by what they stand beside in all
training texts (a table of ``N_ENDINGS`` by ``N_ENDINGS`` counts, a fixed size).  The end token has a class of
its own.  Within a class the words are hashed to ``N_OUTPUTS`` outputs, so that the softmax over a class
has a fixed size whatever the vocabulary; words that share an output have the add-one estimate from all
training tokens among them, with one share for words never seen, so that probabilities sum to one.

Both softmaxes are maximum entropy: a score is the log of the share of the training tokens plus a sum of
weights of hashed features of the history h.  For the class these are the classes of the last one, two and
three words (n-grams), the class of the word before the last alone and the pair of classes around it
(skips), and the last word and the last two words themselves.  For the output within its class they are the
last word and, skipping it, the word before.

Training reads every training document once per epoch.  Each epoch is a Spark job: every partition
starts from the broadcast weights, takes gradient steps over its documents' tokens in batches and
returns the difference; differences are averaged by weight of tokens in a tree of partial sums, by
slice of the weight tables.  The tables have ``buckets_for`` rows each: 2^14 up to 2^28 training tokens, and
twice as many with every fourfold corpus, up to 2^18 (16 MB a table), so that the driver can hold them.

Word counts grow with the corpus and stay distributed.  Words with at least one in ``FREQUENT`` of all
training tokens number at most ``FREQUENT`` and are broadcast; the other words of each document meet
their counts in a shuffle join, pre-aggregated by document, and come back as sums.

Defined cases: a null text is empty and consists of the end token; A-Z count as a-z and words are cut
at ASCII white space; a null key is not held out; without training documents counts are 0 and the
model is uniform; repeated rows are scored each (and counted each); texts of any length are scored
whole, the longest alone in a group; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .syncmers import mix

#: Stands for the end of a text; holds a blank, so no word equals it.
END = b" end"
N_CLASSES = 16
#: Outputs of a class: a power of two, as many as there are classes, so that both tables have rows of one width.
N_OUTPUTS = 16
N_ENDINGS = 512
N_BUCKETS = 1 << 14
MOST_BUCKETS = 1 << 18
FREQUENT = 500_000
EPOCHS = 1
#: Tokens of one gradient step, and its rate.
BATCH = 32_768
RATE = 2.0
#: Values of a class in a history: N_CLASSES and "before the text".
_SIDE = N_CLASSES + 1
#: Active features of a token: five of classes, two of words.
N_FEATURES = 7
#: Active features of an output: two words.
N_WITHIN = 2
#: Distinct words that a counting task holds before it hands its counts on.
HELD = 200_000
#: Rows of the weight table in one partial sum.
SLICE = 1_024

_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_MARK = np.zeros(256, np.int64)
_MARK[list(b".,;:!?")] = 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_ENDING = (mix(np.arange(1 << 16, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(7)) % np.uint64(N_ENDINGS)).astype(np.int64)


def word_codes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hashes, endings, words up to the end of each text) of all words of lower-cased texts.

    An ending is the last two bytes, before one closing mark if there is any; the words are those
    of ``bytes.split()``, found in whole groups of texts at once.
    """
    data = np.frombuffer(b"\n" + b"\n".join(raws) + b"\n", np.uint8)
    blank = _BLANK[data]
    first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    last = np.flatnonzero(~blank[:-1] & blank[1:])
    upto = np.searchsorted(last, np.cumsum([len(r) + 1 for r in raws]))
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), upto
    stem = last - _MARK[data[last]] * (last > first)
    endings = _ENDING[np.where(stem > first, data[stem - 1], 0).astype(np.int64) * 256 + data[stem]]
    size = last - first + 1
    begin = np.cumsum(size) - size
    power = np.cumprod(np.full(int(size.max()), _BASE, np.uint64), dtype=np.uint64)
    letters = _BYTE[data[~blank]] * power[np.arange(int(size.sum())) - np.repeat(begin, size)]
    return mix(np.add.reduceat(letters, begin) + size.astype(np.uint64)), endings, upto


def lowered(text: str | None) -> bytes:
    return text.encode("utf-8").lower() if text else b""


def tokens(text: str | None) -> list[bytes]:
    words = lowered(text).split()
    words.append(END)
    return words


def buckets_for(n_tokens: int) -> int:
    """Rows of each weight table for so many training tokens: they grow with the square root of the corpus."""
    size = N_BUCKETS
    while size < MOST_BUCKETS and n_tokens > (1 << 28) * (size // N_BUCKETS) ** 2:
        size *= 2
    return size


def _bucket(key: np.ndarray, kind: int, n_buckets: int) -> np.ndarray:
    return (mix(key * np.uint64(_BASE) + np.uint64(kind)) >> np.uint64(65 - n_buckets.bit_length())).astype(np.int64)


@lru_cache(maxsize=4)
def _class_features(n_buckets: int) -> np.ndarray:
    """Buckets of the five class features of every history of three classes."""
    h = np.arange(_SIDE**3, dtype=np.uint64)
    side = np.uint64(_SIDE)
    k1, k2, k3 = h // (side * side), h // side % side, h % side
    return np.stack([_bucket(k, j, n_buckets) for j, k in enumerate((k1, k1 * side + k2, h, k2, k1 * side + k3), 1)], axis=1)


@dataclass
class Histories:
    """Of each token: its class and output, the number of its history of classes, the buckets of the last word
    and the last two, and those of the last word and the one before it together with the token's class."""

    c: np.ndarray
    context: np.ndarray
    last: np.ndarray
    pair: np.ndarray
    output: np.ndarray
    near: np.ndarray
    skip: np.ndarray

    def part(self, a: int, n: int) -> Histories:
        return Histories(*(x[a : a + n] for x in (self.c, self.context, self.last, self.pair, self.output, self.near, self.skip)))


def outputs(coded: np.ndarray) -> np.ndarray:
    """The output of every coded token within its class."""
    return (coded >> np.uint64(8)).astype(np.int64) % N_OUTPUTS


def histories(coded: np.ndarray, starts: np.ndarray, n_buckets: int = N_BUCKETS) -> Histories:
    """``coded`` holds hash and class of the tokens of several texts; ``starts``, their first tokens."""
    n = len(coded)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    k = (coded & np.uint64(15)).astype(np.int64)
    context, before = np.zeros(n, np.int64), []
    for back in (1, 2, 3):
        side = np.zeros(n, np.int64)
        side[back:] = k[:-back] + 1
        side[place < back] = 0
        context = context * _SIDE + side
        if back < 3:
            word = np.zeros(n, np.uint64)
            word[back:] = coded[:-back]
            word[place < back] = 0
            before.append(word)
    last, second = before
    own = k.astype(np.uint64)
    near, skip = _bucket(last ^ own, 8, n_buckets), _bucket(second ^ own, 9, n_buckets)  # the low bits are the words' classes
    return Histories(k, context, _bucket(last, 6, n_buckets), _bucket(last * np.uint64(_BASE) + second, 7, n_buckets), outputs(coded), near, skip)


_ONES = np.ones(N_CLASSES, np.float32)


def class_scores(weights: np.ndarray, by_class: np.ndarray, h: Histories) -> np.ndarray:
    """Scores of the classes; ``by_class`` sums prior and class features of every context."""
    z = by_class[h.context]
    z += weights[h.last]
    z += weights[h.pair]
    return np.clip(z, -40, 40, out=z)  # exp stays far from overflow


def log_softmax(weights: np.ndarray, by_class: np.ndarray, h: Histories) -> np.ndarray:
    z = class_scores(weights, by_class, h)
    z -= np.log(np.exp(z) @ _ONES)[:, None]
    return z


def class_sums(weights: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Prior and summed class-feature weights of every history of classes."""
    return (weights[_class_features(len(weights))].sum(axis=1) + prior).astype(np.float32)


def output_scores(weights: np.ndarray, prior: np.ndarray, h: Histories) -> np.ndarray:
    """Scores of the outputs of each token's class; ``prior`` has a row for every class."""
    z = prior[h.c]
    z += weights[h.near]
    z += weights[h.skip]
    return np.clip(z, -40, 40, out=z)


def _row_sums(buckets: np.ndarray, rows: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct buckets, sums of their rows, sums of their weights)."""
    order = np.argsort(buckets.astype(np.uint16) if buckets.max() < 1 << 16 else buckets, kind="stable")
    b = buckets[order]
    starts = np.flatnonzero(np.diff(b, prepend=-1))
    n = np.diff(np.append(starts, len(b))) if weights is None else np.add.reduceat(weights[order], starts)
    return b[starts], np.add.reduceat(rows[order], starts, axis=0), n


def gradient_step(w: np.ndarray, prior: np.ndarray, squares: np.ndarray, h: Histories) -> None:
    """One step up the likelihood of a batch; rarely met features take larger steps."""
    p = np.exp(class_scores(w, class_sums(w, prior), h))
    p /= (p @ _ONES)[:, None]
    p[np.arange(len(h.c)), h.c] -= 1
    met, by_context, n_context = _row_sums(h.context, p)
    parts = [_row_sums(h.last, p), _row_sums(h.pair, p)]
    of_class = _class_features(len(w))
    parts += [_row_sums(of_class[met, j], by_context, n_context) for j in range(of_class.shape[1])]
    _descend(w, squares, parts, RATE / N_FEATURES)


def _descend(w: np.ndarray, squares: np.ndarray, parts: list, rate: float) -> None:
    g, n = np.zeros(w.shape, np.float32), np.zeros(len(w))
    for rows, sums, counts in parts:  # distinct within each part
        g[rows] += sums
        n[rows] += counts
    rows = np.flatnonzero(n)
    squares[rows] += n[rows]
    w[rows] -= (rate * g[rows] / np.sqrt(squares[rows] * n[rows] + 1)[:, None]).astype(np.float32)


def output_step(w: np.ndarray, prior: np.ndarray, squares: np.ndarray, h: Histories) -> None:
    """The same for the outputs within the classes."""
    p = np.exp(output_scores(w, prior, h))
    p /= (p @ _ONES)[:, None]
    p[np.arange(len(h.c)), h.output] -= 1
    _descend(w, squares, [_row_sums(h.near, p), _row_sums(h.skip, p)], RATE / N_WITHIN)


def encode_texts(texts: list, of_ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash with class in the low 4 bits of every token (each text's end has code 0), and the texts' first places."""
    h, e, upto = word_codes([lowered(t) for t in texts])
    number = np.arange(len(texts))
    coded = np.zeros(len(h) + len(texts), np.uint64)
    at = np.ones(len(coded), bool)
    at[upto + number] = False
    coded[at] = h & ~np.uint64(15) | of_ending[e].astype(np.uint64)
    return coded, np.append(0, upto[:-1] + number[1:]) if len(texts) else number


def _groups(texts: list, size: int = 1 << 20) -> Iterator[list]:
    """Neighbouring texts of about ``size`` characters together."""
    at = 0
    while at < len(texts):
        to, n = at, 0
        while to < len(texts) and (to == at or n + len(texts[to] or "") <= size):
            n, to = n + len(texts[to] or ""), to + 1
        yield texts[at:to]
        at = to


def count_words(train: DataFrame) -> DataFrame:
    """(word, c): tokens of the training texts, summed in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        held: Counter = Counter()
        for b in batches:
            for t in b.column("text"):
                held.update(tokens(t.as_py()))
                if len(held) >= HELD:
                    yield out(held)
                    held = Counter()
        if held:
            yield out(held)

    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _summed(parts: DataFrame) -> list:
    """Rows (slice, seen, moved) summed by slice in Spark: a few rows of fixed size come back.

    ``moved`` holds floats, doubles in the sums; a task first adds up what reached it, so no task holds more
    than a slice's sum.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for k, n, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                have = sums.setdefault(k, [0, 0.0])
                have[0] += n
                have[1] = have[1] + np.frombuffer(raw, np.float32).astype(np.float64)
        for k, (n, total) in sums.items():
            yield _part(k, n, total, np.float64)

    return parts.repartition("slice").mapInArrow(add, _PART).collect()


_PART = "slice int, seen long, moved binary"


def _part(k: int, seen: int, moved: np.ndarray, kind: type = np.float32) -> pa.RecordBatch:
    raw = np.ascontiguousarray(moved, kind).tobytes()
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([seen], pa.int64()), pa.array([raw], pa.binary())], ["slice", "seen", "moved"])


def ending_classes(train: DataFrame) -> np.ndarray:
    """The class of every ending, from the neighbours of the endings in all training texts."""
    size = N_ENDINGS * N_ENDINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size)
        for b in batches:
            for group in _groups(b.column("text").to_pylist()):
                _, e, upto = word_codes([lowered(t) for t in group])
                both = np.ones(max(0, len(e) - 1), bool)
                edges = upto[(upto > 0) & (upto < len(e))] - 1
                both[edges] = False  # no pair crosses texts
                table += np.bincount((e[:-1] * N_ENDINGS + e[1:])[both], minlength=size)
        step = size // 16
        for k in range(16):
            yield _part(k, 1, table[k * step : (k + 1) * step])

    table = np.zeros(size)
    for r in _summed(train.select("text").mapInArrow(run, _PART)):
        step = size // 16
        table[r.slice * step : (r.slice + 1) * step] = np.frombuffer(r.moved)
    return cluster_endings(table.reshape(N_ENDINGS, N_ENDINGS))


def cluster_endings(table: np.ndarray, dimensions: int = 12, rounds: int = 30) -> np.ndarray:
    """Classes 1 .. N_CLASSES - 1 by weighted k-means on the endings' neighbour shares.

    The first centre is the commonest ending, each further one the farthest by weight: no chance is in it.
    """
    weight = table.sum(axis=0) + table.sum(axis=1)
    if not weight.any():
        return 1 + np.arange(N_ENDINGS) % (N_CLASSES - 1)
    share = lambda t: t / np.maximum(t.sum(axis=1, keepdims=True), 1)
    x = np.sqrt(np.hstack([share(table), share(table.T)]))
    x -= np.average(x, axis=0, weights=weight)
    _, _, v = np.linalg.svd(x * np.sqrt(weight)[:, None], full_matrices=False)
    x = x @ v[:dimensions].T
    distance = lambda c: ((x[:, None] - c[None]) ** 2).sum(axis=2)
    centres = x[[int(weight.argmax())]]
    while len(centres) < N_CLASSES - 1:
        centres = np.vstack([centres, x[[int((distance(centres).min(axis=1) * weight).argmax())]]])
    for _ in range(rounds):
        near = distance(centres).argmin(axis=1)
        for j in range(len(centres)):
            if weight[near == j].any():
                centres[j] = np.average(x[near == j], axis=0, weights=weight[near == j])
    return 1 + distance(centres).argmin(axis=1)


def train_weights(train: DataFrame, prior: np.ndarray, within: np.ndarray, of_ending: np.ndarray, epochs: int = EPOCHS, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """The weight tables of classes and of outputs, one below the other, after ``epochs`` passes over all training documents."""
    weights = np.zeros((2 * n_buckets, N_CLASSES), np.float32)
    spark = train.sparkSession
    for _ in range(epochs):
        shipped = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            start = shipped.value
            w, seen = start.copy(), 0
            squares = np.ones(len(w))
            classes, outs = slice(0, n_buckets), slice(n_buckets, None)
            for b in batches:
                for group in _groups(b.column("text").to_pylist()):
                    coded, starts = encode_texts(group, of_ending)
                    h = histories(coded, starts, n_buckets)
                    for a in range(0, len(coded), BATCH):
                        now = h.part(a, BATCH)
                        gradient_step(w[classes], prior, squares[classes], now)
                        output_step(w[outs], within, squares[outs], now)
                    seen += len(coded)
            if seen:
                moved = (w - start) * np.float64(seen)
                for s in range(0, len(w), SLICE):
                    yield _part(s // SLICE, seen, moved[s : s + SLICE])

        weights = weights.copy()
        for r in _summed(train.select("text").mapInArrow(run, _PART)):
            weights[r.slice * SLICE : (r.slice + 1) * SLICE] += (np.frombuffer(r.moved) / r.seen).reshape(SLICE, N_CLASSES).astype(np.float32)
    return weights


@dataclass
class Counts:
    """Training tokens and distinct words: all, and by class and output."""

    n: int
    v: int
    n_output: np.ndarray
    v_output: np.ndarray

    def prior(self) -> np.ndarray:
        """Log shares of the classes among the training tokens, where the weights start from."""
        return np.log((self.n_output.sum(axis=1) + 1) / (self.n + N_CLASSES))

    def within(self) -> np.ndarray:
        """Log shares of the outputs within each class; the end token's class has one only."""
        share = np.log((self.n_output + 1) / (self.n_output.sum(axis=1, keepdims=True) + N_OUTPUTS))
        share[0] = np.append(0, np.full(N_OUTPUTS - 1, -40))
        return share.astype(np.float32)


def _class_table(counts: DataFrame, of_ending: np.ndarray) -> Counts:
    size = N_CLASSES * N_OUTPUTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            words = b.column("word").to_pylist()
            k = np.zeros(len(words), np.int64)  # the end token: class and output 0
            real = np.array([w != END for w in words], bool)
            h, e, _ = word_codes([w for w in words if w != END])
            k[real] = of_ending[e] * N_OUTPUTS + outputs(h)
            n += np.bincount(k, b.column("c").to_numpy(), size).astype(np.int64)
            v += np.bincount(k, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(n), pa.array(v)], ["k", "n", "v"])

    rows = counts.mapInArrow(run, "k int, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    n, v = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in rows:
        n[r.k], v[r.k] = r.n, r.v
    shape = (N_CLASSES, N_OUTPUTS)
    return Counts(int(n.sum()), int(v.sum()), n.reshape(shape), v.reshape(shape))


def score_documents(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", epochs: int = EPOCHS, buckets: int | None = None) -> DataFrame:
    """Base and model log10 probabilities of every document; rows of ``held_out`` aren't learnt from."""
    spark = docs.sparkSession
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    train = slim.where(~F.col("held_out"))

    counts = materialize(count_words(train), "word-counts")
    of_ending = ending_classes(train)
    total = _class_table(counts, of_ending)
    n_buckets = buckets or buckets_for(total.n)
    weights = train_weights(train, total.prior(), total.within(), of_ending, epochs, n_buckets)
    # at most FREQUENT words can have this share of the tokens
    frequent = dict(counts.where(F.col("c") * FREQUENT >= max(total.n, 1)).select("word", "c").collect())
    shipped = spark.sparkContext.broadcast(((weights[:n_buckets], weights[n_buckets:]), total, {bytes(w): c for w, c in frequent.items()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, and one for each other distinct word in it."""
        (w, within), total, frequent = shipped.value
        part, row = TaskContext.get().partitionId() << 40, 0
        by_class, shares = class_sums(w, total.prior()), total.within()
        log_output = np.log10(total.n_output + total.v_output + 1.0)
        logs = {x: float(np.log10(c + 1)) for x, c in frequent.items()}
        for b in batches:
            ids, held = b.column("doc_id"), b.column("held_out")
            at = 0
            for group in _groups(b.column("text").to_pylist()):
                coded, starts = encode_texts(group, of_ending)
                h, lp = histories(coded, starts, n_buckets), np.empty(len(coded))
                for a in range(0, len(coded), BATCH):
                    now = h.part(a, BATCH)
                    z = class_scores(w, by_class, now)
                    y, at_ = output_scores(within, shares, now), np.arange(len(now.c))
                    lp[a : a + BATCH] = z[at_, now.c] + y[at_, now.output] - np.log((np.exp(z) @ _ONES) * (np.exp(y) @ _ONES))
                model = np.add.reduceat(lp / np.log(10) - log_output[h.c, h.output], starts)
                rid, n, known, known_log, rare_rid, rare_word, rare_n = [], [], [], [], [], [], []
                for words in map(tokens, group):
                    r = part + row
                    row += 1
                    have = Counter(words)
                    rare = [x for x in have if x not in logs]
                    times = [have.pop(x) for x in rare]
                    rare_word += rare
                    rare_n += times
                    rare_rid += [r] * len(rare)
                    rid.append(r), n.append(len(words)), known.append(len(words) - sum(times)), known_log.append(sum([k * logs[x] for x, k in have.items()], 0.0))
                m, r = len(rid), len(rare_rid)
                none = lambda kind, n=r: pa.nulls(n, kind)
                both = lambda x, y: pa.concat_arrays([x, y])
                yield pa.RecordBatch.from_arrays(
                    [
                        both(pa.array(rid, pa.int64()), pa.array(rare_rid, pa.int64())),
                        both(ids.slice(at, m), none(ids.type)),
                        both(held.slice(at, m), none(pa.bool_())),
                        both(pa.array(n, pa.int64()), pa.array(rare_n, pa.int64())),
                        both(pa.array(known, pa.int64()), none(pa.int64())),
                        both(pa.array(known_log), none(pa.float64())),
                        both(pa.array(model), none(pa.float64())),
                        # a document's own row gets a word that no text has: it spreads evenly and meets no count
                        pa.array([b" %d" % r for r in rid] + rare_word, pa.binary()),
                    ],
                    ["rid", "doc_id", "held_out", "n", "known", "known_log", "model", "word"],
                )
                at += m

    rows = slim.mapInArrow(run, f"rid long, doc_id {kind}, held_out boolean, n long, known long, known_log double, model double, word binary")
    met = rows.join(counts, "word", "left")
    one = F.col("known").isNotNull()  # the document's own row
    summed = met.groupBy("rid").agg(
        F.first(F.when(one, F.col("doc_id")), ignorenulls=True).alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.sum(F.when(one, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(one, F.col("known")).when(F.col("c").isNotNull(), F.col("n"))).alias("n_known"),
        F.sum(F.when(one, F.col("known_log")).when(F.col("c").isNotNull(), F.col("n") * F.log10(F.col("c") + 1.0))).alias("log_counts"),
        F.sum("model").alias("model"),
    )
    norm = float(np.log10(total.n + total.v + 1.0))
    return summed.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.coalesce("n_known", F.lit(0)).alias("n_known"),
        F.lit(total.n).cast("long").alias("train_tokens"),
        (F.coalesce("log_counts", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("model") + F.coalesce("log_counts", F.lit(0.0))).alias("score"),
    )
