"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..scratch import discard, materialize  # noqa: F401  used by the operators


def small_parts(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Batches in parts of so many rows, so that a task holds the Python strings of few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
