"""From split manifests to a training table with the clips inside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import manifests, writers


def run(spark: SparkSession, manifest: str, clips: DataFrame, out: str, splits: tuple[str, ...] = ("train", "test"), roots: tuple[str, ...] = (), keep_silence: bool = False, rate: int = 16_000) -> DataFrame:
    """Write (audio, text, confidence) by split; returns counts of outcomes by split.

    ``clips`` has (path, bytes) of the recordings that exist; clips join their rows by path.  A split
    without a manifest is one row with the outcome ``missing_split``.
    """
    files = manifests.split_files(spark, manifest, list(splits))
    parts = [manifests.read_manifest(spark, p).withColumn("split", F.lit(s)) for s, p in files.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for name, kind in (("audio_path", "string"), ("audio", "string"), ("speaker", "string"), ("text", "string"), ("confidence", "double")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    rows = rows.withColumn("audio_path", F.coalesce(F.nullif("audio_path", F.lit("")), "audio"))
    rows = manifests.resolve_paths(rows, clips, list(roots))
    judged = manifests.load_rows(rows, keep_silence, also=["split"])
    kept = judged.where("outcome = 'kept'").join(clips.select(F.col("path").alias("audio"), "bytes"), "audio")
    audio = F.struct(F.col("audio").alias("path"), "bytes", F.lit(rate).alias("sampling_rate")).alias("audio")
    writers.write_training_table(kept.select(audio, "text", "confidence", "split"), out)
    found = judged.groupBy("split", "outcome").agg(F.count(F.lit(1)).alias("n"))
    missing = [] if manifest.endswith(".jsonl") else [(s, "missing_split", 0) for s in splits if s not in files]
    return found.unionByName(spark.createDataFrame(missing, found.schema)) if missing else found
