"""Manifests: gold rows, training rows, split files, candidate paths of recordings."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.gates import row_outcome
from ..functions.text import strip


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def split_files(spark: SparkSession, folder: str, splits: list[str]) -> dict[str, str]:
    """Paths of the split manifests that exist, by name; a manifest itself is one split by its stem."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there = lambda p: hadoop.Path(p).getFileSystem(conf).exists(hadoop.Path(p))
    if folder.endswith(".jsonl"):
        return {folder.rsplit("/", 1)[-1].removesuffix(".jsonl"): folder}
    found = {s: f"{folder}/{s}.jsonl" for s in splits if there(f"{folder}/{s}.jsonl")}
    if not found:
        raise FileNotFoundError(f"no manifest of {', '.join(splits)} in {folder}")
    return found


def default_roots(manifest: str) -> list[str]:
    """Where relative paths are looked up: the working folder, the manifest's folder and its parent."""
    folder = os.path.abspath(os.path.dirname(manifest) if manifest.endswith(".jsonl") else manifest)
    return [os.getcwd(), folder, os.path.dirname(folder)]


def resolve_paths(rows: DataFrame, listing: DataFrame, roots: list[str], raw: str = "audio_path") -> DataFrame:
    """Rows with ``resolved``: the first of the path itself and the path below each root that is in the listing."""
    candidates = [F.col(raw), *(F.when(~F.col(raw).startswith("/"), F.concat(F.lit(f"{r}/"), F.col(raw))) for r in roots)]
    numbered = rows.withColumn("row_id", F.monotonically_increasing_id())
    tried = numbered.select("row_id", F.posexplode(F.array(*candidates)).alias("rank", "path")).where("path is not null")
    best = tried.join(listing.select("path").distinct(), "path").groupBy("row_id").agg(F.min_by("path", "rank").alias("resolved"))
    return numbered.join(best, "row_id", "left").drop("row_id")


def load_rows(rows: DataFrame, keep_silence: bool = False, path: str = "resolved", also: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Manifest rows with ``outcome`` and the three columns of the training table (and those of ``also``)."""
    return rows.select(
        *also,
        row_outcome(F.col("speaker"), F.col("text"), F.col(path), keep_silence).alias("outcome"),
        F.col(path).alias("audio"),
        strip(F.coalesce("text", F.lit(""))).alias("text"),
        F.col("confidence").cast("float").alias("confidence"),
    )
