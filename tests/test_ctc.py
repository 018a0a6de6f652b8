"""Alignment and posteriors against enumeration of all paths."""

import itertools
import time

import numpy as np
import pytest

from voxloom.functions import ctc


def emissions(rng, frames, outputs):
    e = rng.normal(size=(frames, outputs)) * 2
    return e - np.log(np.exp(e).sum(axis=1, keepdims=True))


def paths(trellis):
    """All rows of states that begin in one of the first two, end in one of the last two and move as they may."""
    for p in itertools.product(range(trellis.n_states), repeat=trellis.n_frames):
        if p[0] <= 1 and p[-1] >= trellis.n_states - 2 and all(0 <= b - a <= 1 or b - a == 2 and trellis.skip[b] for a, b in zip(p, p[1:])):
            yield p


@pytest.mark.parametrize("outputs", [[1], [1, 2], [1, 1], [2, 1, 2], [1, ctc.STAR], [ctc.STAR, ctc.STAR]])
@pytest.mark.parametrize("frames", [2, 3, 4, 5])
def test_small_trellises_equal_enumeration(outputs, frames):
    rng = np.random.default_rng(len(outputs) * 10 + frames)
    e = emissions(rng, frames, 3)
    repeats = sum(a == b for a, b in zip(outputs, outputs[1:]))
    if len(outputs) + repeats > frames:
        with pytest.raises(ValueError):
            ctc.Trellis(e, outputs)
        return
    t = ctc.Trellis(e, outputs)
    value = lambda p: sum(t.emissions[i, t.own[s]] for i, s in enumerate(p))
    every = list(paths(t))
    path, score = ctc.best_path(t)
    assert tuple(path) in every and np.isclose(score, max(map(value, every))) and np.isclose(value(path), score)
    weight = np.exp([value(p) for p in every])
    total, support = np.zeros(t.n_states), np.zeros(t.n_states)
    for p, w in zip(every, weight):
        for i, s in enumerate(p):
            total[s] += w
            support[s] += w * np.exp(t.emissions[i, t.own[s]])
    assert np.allclose(ctc.expected_support(t), (support / total)[1::2])
    for k, (a, b) in enumerate(ctc.spans(path, len(outputs))):
        assert set(path[a:b]) == {2 * k + 1} and (path == 2 * k + 1).sum() == b - a


def test_a_star_is_any_sound():
    e = np.log(np.array([[0.7, 0.2, 0.1], [0.1, 0.4, 0.5]]))
    assert np.allclose(np.exp(ctc.Trellis(e, [ctc.STAR]).emissions[:, -1]), [0.3, 0.9])
    assert np.allclose(np.exp(ctc.Trellis(np.log(e * 0 + [[0.5, 0.0, 0.5]] * 2 + 1e-300), [1]).emissions[:, -1]), 0.5)


def test_blocks_do_not_change_anything():
    rng = np.random.default_rng(5)
    e = emissions(rng, 300, 6)
    outputs = rng.integers(1, 6, 90).tolist()
    got = []
    for step in (1, 7, 300):
        t = ctc.Trellis(e, outputs)
        t.step = step
        got.append((ctc.best_path(t), ctc.expected_support(t)))
    for (path, score), support in got[1:]:
        assert (path == got[0][0][0]).all() and score == got[0][0][1] and np.allclose(support, got[0][1])


VOCABULARY = {c: i for i, c in enumerate("abcdefghij", 1)}


def spoken(letters, frames_each=3, gap=2, sure=0.9):
    """Emissions of a voice that says these letters one after another; a blank is a pause of three gaps."""
    rows = []
    for c in letters:
        for k, n in ((0, gap), (VOCABULARY.get(c, 0), frames_each)):
            row = np.full(11, (1 - sure) / 10)
            row[k] = sure
            rows += [row] * n
    return np.log(np.array(rows))


def test_words_have_times_and_scores():
    e = spoken("abc de")
    words = ctc.align_words(e, 0.02, "abc de", VOCABULARY, star=False)
    assert [w[0] for w in words] == ["abc", "de"]
    assert np.allclose([w[1:3] for w in words], [(2 * 0.02, 15 * 0.02), (22 * 0.02, 30 * 0.02)]) and np.allclose([w[3] for w in words], 0.9)
    # sound before and after the text goes to the stars; a word without letters has times but no score
    words = ctc.align_words(spoken("jjabc de"), 0.02, "abc !? de", VOCABULARY)
    assert [w[0] for w in words] == ["abc", "!?", "de"] and words[1][3] is None and words[0][1] >= 10 * 0.02 and min(words[0][3], words[2][3]) > 0.8
    assert ctc.align_words(e, 0.02, "  ", VOCABULARY) == []
    with pytest.raises(ValueError):
        ctc.align_words(e[:3], 0.02, "abc de", VOCABULARY)


def test_posterior_tells_right_texts_from_wrong_ones():
    e = spoken("abc de")
    assert ctc.mean_word_posterior(e, "abc de", VOCABULARY) > 0.85
    assert ctc.mean_word_posterior(e, "jih gf", VOCABULARY) < 0.2
    assert 0.4 < ctc.mean_word_posterior(e, "abc gf", VOCABULARY) < 0.6
    assert ctc.mean_word_posterior(e, "?!", VOCABULARY) is None and ctc.mean_word_posterior(e, "", VOCABULARY) is None


def test_ten_minutes_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(2)
    n_letters = 4_000
    letters = rng.integers(1, 31, n_letters)
    e = np.full((30_000, 32), np.log(0.1 / 31), np.float32)
    at = np.linspace(3, 29_990, n_letters).astype(int)
    e[:, 0] = np.log(0.9)
    e[at] = np.log(0.1 / 31)
    e[at, letters] = np.log(0.9)
    tracemalloc.start()
    began = time.perf_counter()
    path, _ = ctc.best_path(ctc.Trellis(e, letters.tolist()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert time.perf_counter() - began < 120 and peak < 200e6  # the whole trellis has 240 million cells
    assert (ctc.spans(path, n_letters)[:, 0] == at).all()
