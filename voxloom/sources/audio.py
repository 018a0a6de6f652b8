"""Recordings as rows, decoded inside Arrow functions.

Where tasks can open files themselves, rows carry only the path, and ``Sound`` reads what a row needs of it: the whole
recording, or the bytes behind a span.  Where only Spark's readers reach the files, rows carry their content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio
from ..functions.audio import decode_wav, resample

Decoder = Callable[[bytes], tuple[np.ndarray, int]]
#: Opens a recording by its path, inside a task.
Opener = Callable[[str], BinaryIO]


def open_file(path: str) -> BinaryIO:
    """A file that the task's machine has under this path, as one in a mounted shared folder."""
    return open("/" + path.split(":", 1)[-1].lstrip("/"), "rb")


def opener_for(root: str) -> Opener | None:
    """``open_file`` for local paths; for other stores none, as only Spark may reach them."""
    return open_file if root.startswith(("/", "file:")) or ":" not in root else None


class Sound:
    """One recording at a target rate, whole or by span; it is decoded no further than asked for.

    A span is read by itself where the recording can be opened, is one of those that ``decode_wav`` knows, and resampling
    is band-limited (so that an output depends on few inputs); the samples are those of the whole recording's.
    """

    def __init__(self, path: str, content: bytes | None, target: int, resampler: str = "sinc", decoder: Decoder = decode_wav, opener: Opener | None = None):
        self.path, self.content, self.target, self.resampler, self.decoder, self.opener = path, content, target, resampler, decoder, opener
        self.by_span = content is None and decoder is decode_wav and resampler == "sinc"

    @cached_property
    def _file(self) -> BinaryIO:
        return self.opener(self.path)

    def _read(self, at: int, n: int) -> bytes:
        self._file.seek(at)
        return self._file.read(n)

    @cached_property
    def _layout(self) -> audio.Layout:
        return audio.wav_layout(self._read)

    @cached_property
    def channels(self) -> np.ndarray:
        """All samples, channels x time."""
        content = self.content
        if content is None:
            self._file.seek(0)
            content = self._file.read()
        x, rate = self.decoder(content)
        return resample(x, rate, self.target, self.resampler)

    def cut(self, channel: int, start: float, end: float, pad: float) -> np.ndarray:
        """What ``functions.audio.cut`` gives of the channel."""
        if not self.by_span:
            return audio.cut(self.channels[channel], self.target, start, end, pad)
        own = self._layout
        n = audio.resampled_length(own.n_frames, own.rate, self.target)
        first, end_ = audio.sample_range(n, self.target, start, end, pad)
        if end_ <= first:
            return np.zeros(0, np.float32)
        a, b = audio.inputs_of(first, end_, own.rate, self.target)
        a, b = max(a, 0), min(b, own.n_frames)
        part = audio.decode_range(self._read, own, a, b)[channel : channel + 1]
        return audio.resample_part(part, a, first, end_, own.rate, self.target)[0]

    def close(self) -> None:
        if "_file" in self.__dict__:
            self._file.close()


def _pcm(x: np.ndarray) -> bytes:
    return np.clip(np.rint(x * 32767), -32768, 32767).astype("<i2").tobytes()


def read_recordings(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) of every recording below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.wav").load(root)
    return files.select("path", "content")


def read_clips(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of clips: a table that ``writers.clip_table`` made, or the recordings below a folder."""

    def files(glob: str) -> DataFrame:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)

    if files("*.parquet").select("path").take(1):
        return spark.read.option("recursiveFileLookup", "true").parquet(folder).select("path", "bytes")
    return files("*.wav").select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.col("content").alias("bytes"))


def decode(recordings: DataFrame, target_sr: int, decoder: Decoder = decode_wav, resampler: str = "sinc") -> DataFrame:
    """(path, channel, rate, samples) with 16-bit samples; ``error`` in place of a recording that fails.

    ``decoder`` may be any function of a file's bytes, so formats beyond PCM are a plugin.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                try:
                    x, rate = decoder(content)
                    x = resample(x, rate, target_sr, resampler)
                    pcm = [_pcm(c) for c in x]
                    yield pd.DataFrame({"path": path, "channel": range(len(pcm)), "rate": target_sr, "samples": pcm, "error": None})
                except Exception as e:  # noqa: BLE001  a bad file is a row, not a failed job
                    yield pd.DataFrame({"path": [path], "channel": [None], "rate": [None], "samples": [None], "error": [str(e)[:300]]})

    return recordings.mapInPandas(run, "path string, channel int, rate int, samples binary, error string")
