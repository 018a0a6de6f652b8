"""Sinks: manifests, lists, tables and clips."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.audio import encode_wav
from ..functions.numbers import python_round


def write_jsonl(df: DataFrame, path: str) -> int:
    """JSON lines with explicit nulls; the count is observed while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("ignoreNullFields", "false").mode("overwrite").json(path)
    return seen.get["n"]


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def skipped_line(path: str = "wav_path", reason: str | None = None) -> Column:
    return F.concat_ws("\t", path, reason) if reason else F.col(path)


def clip_line() -> Column:
    """A clip's path, tier with confidence, and text, parted by tabs.

    The confidence is rounded from its exact binary value first, as format_string rounds what it would print in full.
    """
    label = F.format_string("%s(%.2f)", F.coalesce("tier", F.lit("?")), python_round(F.coalesce("confidence", F.lit(0.0)), 2))
    return F.concat_ws("\t", F.col("audio_path"), label, F.col("text"))


def write_clip_list(df: DataFrame, path: str) -> None:
    write_lines(df.where("audio_path is not null"), clip_line(), path)


def write_stats(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_training_table(rows: DataFrame, path: str) -> None:
    """Kept rows as Parquet by split; a split without rows has no folder."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def for_audio_training(manifest: DataFrame) -> DataFrame:
    """The manifest with the column name that audio loaders expect."""
    return manifest.withColumnRenamed("audio_path", "audio")


def clip_table(rendered: DataFrame, rate: int) -> DataFrame:
    """(path, bytes): every rendered clip as a 16-bit recording, for a table or for files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["audio_path"], "bytes": [encode_wav(np.frombuffer(s, "<i2") / 32767, rate) for s in b["samples"]]})

    return rendered.select("audio_path", "samples").mapInPandas(run, "path string, bytes binary")
