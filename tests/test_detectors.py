"""The learning detector against enumeration of state paths, and against the fixed threshold in noise."""

import itertools

import numpy as np
import pytest

from voxloom.functions import detectors
from voxloom.functions.audio import speech_regions

RATE = 8_000


def score(step, seen, start, path):
    return start[path[0]] + sum(step[a, b] for a, b in zip(path, path[1:])) + sum(seen[t, s] for t, s in enumerate(path))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 10])
def test_short_signals_equal_enumeration(n):
    rng = np.random.default_rng(n)
    step = np.log(rng.dirichlet([1, 1], 2))
    seen, start = rng.normal(size=(n, 2)) * 2, np.log(rng.dirichlet([1, 1]))
    every = list(itertools.product((0, 1), repeat=n))
    value = np.array([score(step, seen, start, p) for p in every])
    assert tuple(detectors.best_states(step, seen, start)) == every[int(value.argmax())]
    weight = np.exp(value - np.logaddexp.reduce(value))
    state, moves, whole = detectors.posteriors(step, seen, start)
    paths = np.array(every)
    assert np.isclose(whole, np.logaddexp.reduce(value))
    assert np.allclose(np.exp(state[:, 1]), weight @ paths) and np.allclose(np.exp(state).sum(axis=1), 1)
    want = [[sum(w * ((p[:-1] == a) & (p[1:] == b)).sum() for w, p in zip(weight, paths)) for b in (0, 1)] for a in (0, 1)]
    assert np.allclose(np.exp(moves), want)


def voice(rng, parts, seconds, noise, loud):
    x = rng.normal(size=int(seconds * RATE)) * noise
    for a, b in parts:
        at = slice(int(a * RATE), int(b * RATE))
        x[at] += rng.normal(size=at.stop - at.start) * loud
    return x.astype(np.float32)


def agreement(regions, parts, seconds):
    t = np.arange(0, seconds, 0.01)
    inside = lambda rows: sum(((t >= a) & (t < b)).astype(int) for a, b in rows) > 0
    return float((inside(regions) == inside(parts)).mean()) if len(regions) else float((~inside(parts)).mean())


PARTS = [(1.0, 2.5), (4.0, 4.6), (6.2, 9.0)]


def test_a_raised_noise_floor_is_no_speech():
    rng = np.random.default_rng(1)
    for noise, loud in ((0.03, 0.2), (0.1, 0.5)):
        x = voice(rng, PARTS, 10, noise, loud)
        learned, fixed = (agreement(f(x, RATE), PARTS, 10) for f in (detectors.learned_regions, speech_regions))
        assert learned > 0.97 and fixed < 0.6  # the noise alone lies above -35 dB


def test_a_quiet_speaker_is_heard():
    x = voice(np.random.default_rng(2), PARTS, 10, 0.0005, 0.008)
    assert agreement(detectors.learned_regions(x, RATE), PARTS, 10) > 0.97 and len(speech_regions(x, RATE)) == 0


def test_signals_of_one_kind():
    rng = np.random.default_rng(3)
    assert len(detectors.learned_regions(np.zeros(RATE * 3, np.float32), RATE)) == 0
    assert len(detectors.learned_regions(np.zeros(0, np.float32), RATE)) == 0 and len(detectors.learned_regions(np.zeros(300, np.float32), RATE)) == 0
    assert detectors.learned_regions(rng.normal(size=RATE * 3) * 0.2, RATE).tolist() == speech_regions(np.ones(RATE * 3), RATE).tolist()


def test_an_hour_is_quick():
    import time

    x = voice(np.random.default_rng(4), [(k, k + 1.5) for k in range(0, 3600, 4)], 3600, 0.02, 0.3)
    began = time.perf_counter()
    found = detectors.load()(x, RATE)
    assert 890 <= len(found) <= 910 and time.perf_counter() - began < 60
