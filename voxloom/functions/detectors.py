"""A speech detector that learns its levels from the signal: a two-state hidden Markov model on the log energies of frames.

Each channel is fitted by itself with expectation maximisation: two levels with their spread, and how likely either state is
to stay.  The louder state is speech, and the best path through the states (Viterbi) gives its stretches.  So a raised
noise floor or a quiet speaker moves the levels with it, where a fixed threshold hears all or nothing.

Messages pass all frames in blocks side by side: the transfer of each block is worked out for all blocks at once, then
blocks are chained, then each is filled in.  A signal whose two levels lie less than ``CONTRAST`` apart has only one kind of
frame; there the fixed threshold decides.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .audio import FRAME_MS, speech_regions

ROUNDS = 12
#: Decibels: least difference of the levels, least spread of either.
CONTRAST, LEAST_SPREAD = 8.0, 2.0
#: A first guess of how long a state lasts, in frames.
STAY = 12.0


def messages(step: np.ndarray, seen: np.ndarray, start: np.ndarray, join: Callable) -> np.ndarray:
    """Forward messages (frames x 2): ``start`` and then each frame's best or summed (``join``) way in, plus what is ``seen`` there."""
    n = len(seen)
    size = max(1, int(np.sqrt(n)))
    n_blocks = -(-n // size)
    rows = np.zeros((n_blocks * size, 2))
    rows[:n] = seen
    rows = rows.reshape(n_blocks, size, 2)
    through = np.full((n_blocks, 2, 2), -np.inf)  # from the first frame of a block to its last
    through[:, 0, 0], through[:, 1, 1] = rows[:, 0, 0], rows[:, 0, 1]
    for k in range(1, size):
        through = join(through[:, :, 0, None] + step[None, None, 0], through[:, :, 1, None] + step[None, None, 1]) + rows[:, k, None, :]
    enter = np.empty((n_blocks, 2))
    enter[0] = start
    for b in range(1, n_blocks):
        leave = join(enter[b - 1, 0] + through[b - 1, 0], enter[b - 1, 1] + through[b - 1, 1])
        enter[b] = join(leave[0] + step[0], leave[1] + step[1])
    out = np.empty_like(rows)
    out[:, 0] = enter + rows[:, 0]
    for k in range(1, size):
        out[:, k] = join(out[:, k - 1, :1] + step[0], out[:, k - 1, 1:] + step[1]) + rows[:, k]
    return out.reshape(-1, 2)[:n]


def posteriors(step: np.ndarray, seen: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(log probability of each state in each frame, log expected transitions, log likelihood)."""
    forward = messages(step, seen, start, np.logaddexp)
    back = messages(step.T, seen[::-1], np.zeros(2), np.logaddexp)[::-1]  # with the frame's own evidence
    whole = float(np.logaddexp(*forward[-1]))
    moves = forward[:-1, :, None] + step[None] + back[1:, None, :] - whole
    return forward + back - seen - whole, np.logaddexp.reduce(moves, axis=0) if len(moves) else np.full((2, 2), -np.inf), whole


def best_states(step: np.ndarray, seen: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The likeliest path; of equal ones the one that changes least, seen from the end."""
    forward = messages(step, seen, start, np.maximum)
    stay, change = np.diag(step), step[::-1].diagonal()  # into each state: from itself, from the other
    other = forward[:-1, ::-1] + change > forward[:-1] + stay
    path = np.empty(len(seen), np.int64)
    state = path[-1] = int(forward[-1, 1] > forward[-1, 0])
    turns = other.tolist()
    for t in range(len(seen) - 2, -1, -1):
        state = 1 - state if turns[t][state] else state
        path[t] = state
    return path


def _evidence(level: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return -0.5 * ((level[:, None] - mean) / spread) ** 2 - np.log(spread)


def frame_levels(x: np.ndarray, rate: int, frame_ms: int = FRAME_MS) -> np.ndarray:
    """Decibels of whole frames; a ragged tail is ignored."""
    frame = max(1, rate * frame_ms // 1000)
    n = len(x) // frame
    return 10 * np.log10((x[: n * frame].reshape(n, frame).astype(np.float64) ** 2).mean(axis=1) + 1e-10) if n else np.zeros(0)


def fit_levels(level: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(means, spreads, log transitions, log start) of the quieter and the louder state."""
    mean = np.quantile(level, [0.1, 0.9])
    spread = np.full(2, max(LEAST_SPREAD, (mean[1] - mean[0]) / 4))
    stay = 1 - 1 / STAY
    step, start = np.log(np.array([[stay, 1 - stay], [1 - stay, stay]])), np.log([0.5, 0.5])
    for _ in range(rounds):
        state, moves, _ = posteriors(step, _evidence(level, mean, spread), start)
        share = np.exp(state)
        weight = share.sum(axis=0) + 1e-9
        mean = (share * level[:, None]).sum(axis=0) / weight
        spread = np.maximum(np.sqrt((share * (level[:, None] - mean) ** 2).sum(axis=0) / weight), LEAST_SPREAD)
        counts = np.exp(moves) + np.array([[STAY, 1.0], [1.0, STAY]])  # a few moves that nobody saw, so that none is impossible
        step, start = np.log(counts / counts.sum(axis=1, keepdims=True)), state[0] - np.logaddexp(*state[0])
    if mean[0] > mean[1]:
        mean, spread, step, start = mean[::-1], spread[::-1], step[::-1, ::-1], start[::-1]
    return mean, spread, step, start


def learned_regions(x: np.ndarray, rate: int) -> np.ndarray:
    """Rows (start, end) in seconds of the stretches of the louder state."""
    level = frame_levels(x, rate)
    if len(level) < 3:
        return speech_regions(x, rate)
    mean, spread, step, start = fit_levels(level)
    if mean[1] - mean[0] < CONTRAST:
        return speech_regions(x, rate)
    active = np.concatenate([[0], best_states(step, _evidence(level, mean, spread), start), [0]])
    edges = np.diff(active)
    frame = max(1, rate * FRAME_MS // 1000)
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], axis=1) * frame / rate


def load() -> Callable[[np.ndarray, int], np.ndarray]:
    """The detector as a plugin (``--vad voxloom.functions.detectors:load``)."""
    return learned_regions
