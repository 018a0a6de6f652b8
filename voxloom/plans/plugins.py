"""Acoustic models as plugins; each is loaded once in every Python worker that runs it.

A plugin is a function without arguments that returns the model: a callable on single clips.
None of the acoustic models is part of this repository; without a plugin its column is null.  What follows from a
model's emissions is: ``ctc_aligner`` and ``ctc_scorer`` make an aligner and a scorer of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import ctc
from ..functions.audio import speech_regions


class Vad(Protocol):
    def __call__(self, x: np.ndarray, rate: int) -> np.ndarray:
        """Rows (start, end) of speech in seconds."""


class Scorer(Protocol):
    def __call__(self, text: str, x: np.ndarray, rate: int) -> float | None:
        """Mean posterior of the words."""


class Transcriber(Protocol):
    """May also have ``batch(clips, rate)``, the transcripts of several clips at once."""

    def __call__(self, x: np.ndarray, rate: int) -> str | None:
        """A second transcript."""


class WordAligner(Protocol):
    def __call__(self, x: np.ndarray, rate: int, text: str) -> list[tuple[str, float, float, float | None]]:
        """Words with start, end and score; a missing score counts as 1."""


class Acoustic(Protocol):
    """A model with outputs for letters; output ``blank`` (0 if it has no such attribute) is none of them."""

    vocabulary: dict[str, int]

    def __call__(self, x: np.ndarray, rate: int) -> tuple[np.ndarray, float]:
        """(log probabilities, frames x outputs; seconds of a frame)."""


def ctc_aligner(acoustic: Callable[[], Acoustic], star: bool = True) -> Callable[[], WordAligner]:
    """A word aligner from emissions: the best path through the text's letters."""

    def load() -> WordAligner:
        model = acoustic()

        def align(x: np.ndarray, rate: int, text: str) -> list[tuple[str, float, float, float | None]]:
            emissions, stride = model(x, rate)
            return ctc.align_words(emissions, stride, text, model.vocabulary, getattr(model, "blank", 0), star)

        return align

    return load


def ctc_scorer(acoustic: Callable[[], Acoustic]) -> Callable[[], Scorer]:
    """A scorer from emissions: the mean posterior of the words over all paths through the text's letters."""

    def load() -> Scorer:
        model = acoustic()
        return lambda text, x, rate: ctc.mean_word_posterior(model(x, rate)[0], text, model.vocabulary, getattr(model, "blank", 0))

    return load


@dataclass(frozen=True)
class Plugins:
    vad: Callable[[], Vad] = lambda: speech_regions
    scorer: Callable[[], Scorer] | None = None
    transcriber: Callable[[], Transcriber] | None = None
    word_aligner: Callable[[], WordAligner] | None = None


def detector(plugin: Callable[[], Vad]) -> Vad:
    """The speech detector; where it can't be loaded or fails on a signal, the energy threshold stands in."""
    model = _guarded(plugin)

    def rows(x: np.ndarray, rate: int) -> np.ndarray:
        return np.asarray(model(x, rate), float).reshape(-1, 2)

    def regions(x: np.ndarray, rate: int) -> np.ndarray:
        found = _guarded(rows, x, rate) if model is not None else None
        return speech_regions(x, rate) if found is None else found

    return regions


def _pcm(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i2").astype(np.float32) / 32767


def _guarded(model, *args):
    try:
        return model(*args)
    except Exception:  # noqa: BLE001  a model's failure on one clip is a null, for that clip alone
        return None


def score_column(plugin: Callable[[], Scorer] | None, text: str, samples: str, rate: int) -> Column:
    if plugin is None:
        return F.lit(None).cast("double")

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = plugin()
        for texts, raws in batches:
            yield pd.Series([_guarded(model, t, _pcm(r), rate) if t and t.strip() and r else None for t, r in zip(texts, raws)], dtype="float64")

    return run(text, samples)


def _transcripts(model: Transcriber, clips: list[np.ndarray], rate: int) -> list[str | None]:
    """Of several clips; a batch that fails is taken clip by clip, so that a bad one costs only itself."""
    together = getattr(model, "batch", None)
    found = _guarded(together, clips, rate) if together and clips else None
    return list(found) if found is not None and len(found) == len(clips) else [_guarded(model, x, rate) for x in clips]


def transcript_column(plugin: Callable[[], Transcriber] | None, samples: str, rate: int, batch_size: int = 8) -> Column:
    if plugin is None:
        return F.lit(None).cast("string")

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = plugin()
        for raws in batches:
            out = pd.Series([None] * len(raws), dtype="object")
            there = [i for i, r in enumerate(raws) if r]
            for a in range(0, len(there), max(1, batch_size)):
                part = there[a : a + max(1, batch_size)]
                for i, t in zip(part, _transcripts(model, [_pcm(raws.iloc[i]) for i in part], rate)):
                    out.iloc[i] = t
            yield out

    return run(samples)


def aligned_words(model: WordAligner, sound: Callable[[], np.ndarray], rate: int, text: str) -> tuple[list[dict], str | None]:
    """(words, error) of one channel; an error is kept, as it skips the call.  Without text nothing is decoded."""
    if not text or not text.strip():
        return [], None
    try:
        x = sound()
        found = model(x, rate, text.strip()) if len(x) else []
        return [{"text": w, "start": float(a), "end": float(b), "score": 1.0 if s is None else float(s)} for w, a, b, s in found], None
    except Exception as e:  # noqa: BLE001
        return [], str(e)[:300] or type(e).__name__
