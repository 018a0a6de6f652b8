"""Connectionist temporal classification on the outputs of an acoustic model: where each word of a known text
is spoken, and how well the sound bears it out.

A model gives emissions, the log probability of every output (one of them blank) in every frame.  The text
is a row of outputs; between and around them stand blanks, so the trellis has 2 n + 1 states: each frame stays,
moves on by one state, or skips a blank between two different outputs.  Only states that can be reached from
the start and can still reach the end are worked (a band around the diagonal).

Columns of the trellis are kept at every ``sqrt(frames)``-th frame only; a block between two of them is worked again
when its inner columns are needed.  So memory grows with states * sqrt(frames), and results are those of the whole
trellis: the best path and the sums over all paths are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

#: Stands in a row of outputs for any sound: its probability is that of all outputs but the blank.
STAR = -1


@dataclass(frozen=True)
class Word:
    """A word of the text and its place in the row of outputs; one without known letters is a star."""

    text: str
    first: int
    end: int


class Trellis:
    """States, reachable bands and columns for one row of outputs over one matrix of emissions."""

    def __init__(self, emissions: np.ndarray, outputs: list[int], blank: int = 0):
        e = np.asarray(emissions, float)
        if e.ndim != 2 or not len(e):
            raise ValueError("emissions must be frames x outputs")
        with np.errstate(divide="ignore", invalid="ignore"):
            others = np.delete(e, blank, axis=1)
            top = others.max(axis=1, initial=-np.inf)
            sound = top + np.log(np.exp(others - np.where(np.isfinite(top), top, 0)[:, None]).sum(axis=1))
        self.emissions = np.concatenate([e, np.nan_to_num(sound, nan=-np.inf, neginf=-np.inf)[:, None]], axis=1)
        self.outputs = np.array(outputs, np.int64)
        self.own = np.full(2 * len(outputs) + 1, blank)
        self.own[1::2] = np.where(self.outputs == STAR, e.shape[1], self.outputs)
        #: whether a state may be entered from the one but one before it
        self.skip = np.zeros(len(self.own), bool)
        self.skip[3::2] = self.own[3::2] != self.own[1:-2:2]
        self.n_frames, self.n_states = len(e), len(self.own)
        repeats = int((~self.skip[3::2]).sum())
        if len(outputs) + repeats > self.n_frames:
            raise ValueError(f"{self.n_frames} frames can't hold {len(outputs)} outputs")
        self.step = max(1, int(np.sqrt(self.n_frames)))

    def band(self, t: int) -> tuple[int, int]:
        """First state and end of those that lie on any path at frame t."""
        return max(0, self.n_states - 2 * (self.n_frames - t)), min(self.n_states, 2 * (t + 1))

    def scores(self, t: int) -> np.ndarray:
        a, b = self.band(t)
        return self.emissions[t, self.own[a:b]]

    def moves(self, column: np.ndarray, t: int) -> np.ndarray:
        """(3 x states of frame t): what staying, moving on and skipping bring from the column of frame t - 1."""
        (pa, pb), (a, b) = self.band(t - 1), self.band(t)
        wide = np.full(b - pa + 2, -np.inf)  # states pa - 2 .. b - 1
        wide[2 : 2 + pb - pa] = column
        at = np.arange(a, b) - pa + 2
        skipped = np.where(self.skip[a:b], wide[at - 2], -np.inf)
        return np.stack([wide[at], wide[at - 1], skipped])

    def columns(self, begin: int, end: int, column: np.ndarray | None, combine: Callable) -> Iterator[tuple[int, np.ndarray]]:
        """(t, column) for the frames of [begin, end), on from the column of frame begin - 1."""
        for t in range(begin, end):
            column = self.scores(t).copy() if t == 0 else combine(self.moves(column, t)) + self.scores(t)
            yield t, column

    def blocks(self, combine: Callable) -> Iterator[tuple[int, int, np.ndarray | None]]:
        """(begin, end, column before it) of all blocks, the last first."""
        kept, before = [], None
        for t, column in self.columns(0, self.n_frames, None, combine):
            if t % self.step == 0:
                kept.append((t, before))
            before = column
        ends = [t for t, _ in kept[1:]] + [self.n_frames]
        for (begin, column), end in zip(reversed(kept), reversed(ends)):
            yield begin, end, column


def _log_sum(moves: np.ndarray) -> np.ndarray:
    top = moves.max(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.isfinite(top), top + np.log(np.exp(moves - np.where(np.isfinite(top), top, 0)).sum(axis=0)), -np.inf)


def best_path(trellis: Trellis) -> tuple[np.ndarray, float]:
    """(state of every frame, score) of the best path; of equal ones the one that moves least, seen from the end."""
    best = lambda moves: moves.max(axis=0)
    path = np.zeros(trellis.n_frames, np.int64)
    score, state = None, -1
    for begin, end, column in trellis.blocks(best):
        came = []
        for t in range(begin, end):
            if t == 0:
                column = trellis.scores(0).copy()
                came.append(np.zeros(len(column), np.int8))
            else:
                moves = trellis.moves(column, t)
                came.append(moves.argmax(axis=0).astype(np.int8))
                column = moves.max(axis=0) + trellis.scores(t)
        if score is None:
            a, b = trellis.band(trellis.n_frames - 1)
            last = column[-2:] if b - a > 1 else column
            state = b - 1 - int(np.argmax(last[::-1]))
            score = float(column[state - a])
            if not np.isfinite(score):
                raise ValueError("no path has a probability above 0")
        for t in range(end - 1, begin - 1, -1):
            path[t] = state
            state -= int(came[t - begin][state - trellis.band(t)[0]])
    return path, score


def spans(path: np.ndarray, n_outputs: int) -> np.ndarray:
    """Rows (first frame, end) of every output on a path."""
    frames = np.flatnonzero(path % 2 == 1)
    own = path[frames] // 2
    first = frames[np.searchsorted(own, np.arange(n_outputs))]
    last = frames[np.searchsorted(own, np.arange(n_outputs), "right") - 1]
    return np.stack([first, last + 1], axis=1)


def expected_support(trellis: Trellis) -> np.ndarray:
    """Of every output, its emitted probability on average over the frames that it takes, over all paths.

    Each frame counts with the probability, given the text, that the output is spoken there (forward-backward).
    """
    total, support = np.zeros(trellis.n_states), np.zeros(trellis.n_states)
    ahead = whole = None
    for begin, end, column in trellis.blocks(_log_sum):
        forward = [c for _, c in trellis.columns(begin, end, column, _log_sum)]
        for t in range(end - 1, begin - 1, -1):
            a, b = trellis.band(t)
            if ahead is None:
                ahead = np.full(b - a, -np.inf)  # log probability of what follows, from each state
                ahead[-2:] = 0
                whole = float(_log_sum((forward[-1] + ahead)[:, None])[0])
                if not np.isfinite(whole):
                    raise ValueError("no path has a probability above 0")
            else:
                na, nb = trellis.band(t + 1)
                wide = np.full(nb - a + 2, -np.inf)  # states a .. nb + 1
                wide[na - a : nb - a] = ahead + trellis.scores(t + 1)
                at = np.arange(a, b) - a
                wide = np.append(wide, np.full(max(0, b - a + 2 - len(wide)), -np.inf))
                over = np.zeros(b - a, bool)
                reach = trellis.skip[a + 2 : b + 2]
                over[: len(reach)] = reach
                ahead = _log_sum(np.stack([wide[at], wide[at + 1], np.where(over, wide[at + 2], -np.inf)]))
            share = np.exp(forward[t - begin] + ahead - whole)
            total[a:b] += share
            support[a:b] += share * np.exp(trellis.scores(t))
    return support[1::2] / total[1::2]


def spell(text: str, vocabulary: dict[str, int], star: bool = True) -> tuple[list[int], list[Word]]:
    """(outputs, words): every word's letters; a star before and after the text takes sound that it doesn't hold.

    Letters without an output are left out; a word without any is a star of its own.
    """
    outputs, words = [STAR] if star else [], []
    for w in text.split():
        own = [vocabulary[c] for c in w if c in vocabulary] or [STAR]
        words.append(Word(w, len(outputs), len(outputs) + len(own)))
        outputs += own
    return outputs + ([STAR] if star else []), words


def align_words(emissions: np.ndarray, stride: float, text: str, vocabulary: dict[str, int], blank: int = 0, star: bool = True) -> list[tuple[str, float, float, float | None]]:
    """(word, start, end, score) by the best path; the score is the mean probability of the word's outputs in their frames.

    A word without known letters has no score.
    """
    outputs, words = spell(text, vocabulary, star)
    if not words:
        return []
    trellis = Trellis(emissions, outputs, blank)
    path, _ = best_path(trellis)
    place = spans(path, len(outputs))
    p = np.exp(trellis.emissions[np.arange(len(path)), trellis.own[path]])
    voiced = np.append(0, np.cumsum(path % 2 == 1))
    upto = np.append(0, np.cumsum(np.where(path % 2 == 1, p, 0)))
    rows = []
    for w in words:
        a, b = place[w.first, 0], place[w.end - 1, 1]
        known = outputs[w.first] != STAR
        rows.append((w.text, a * stride, b * stride, float((upto[b] - upto[a]) / (voiced[b] - voiced[a])) if known else None))
    return rows


def mean_word_posterior(emissions: np.ndarray, text: str, vocabulary: dict[str, int], blank: int = 0) -> float | None:
    """Mean over the words of the mean support of their letters; none without a word that has letters."""
    outputs, words = spell(text, vocabulary, star=False)
    known = [w for w in words if outputs[w.first] != STAR]
    if not known:
        return None
    support = expected_support(Trellis(emissions, outputs, blank))
    return float(np.mean([support[w.first : w.end].mean() for w in known]))
