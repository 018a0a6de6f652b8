"""The shared test tables seen as calls, turns, signals and scores."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settings import Chunking, Gates, Settings

HOUR = 3_600_000_000.0
#: What is added to a document's id for its twin.
TWINS = 1_000_000_000_000

#: Folders whose names order otherwise as text than as parts of a path.
FOLDERS = ("/c/a-b", "/c/a", "/c/a.b", "/c")

#: Turn limits that suit conversations (roles alternate) and event times in microseconds.
TALK = replace(Settings(), chunk=Chunking(max_s=60.0, target_mean_s=30.0, merge_gap_max_s=10.0))
EVENTS = replace(Settings(), chunk=Chunking(max_s=36 * HOUR, target_mean_s=18 * HOUR, merge_gap_max_s=6 * HOUR, split_silence_s=5 * HOUR))
STRICT = replace(Settings(), filt=Gates(require_audio_quality_good=True))
#: Letters that count as in script where Latin text stands in for Persian: lower case.
SCRIPT = ("0061", "024F")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def talk_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts: 20 ms a character, every third turn crossed."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    ms = 20 * F.length("text")
    rows = table(spark, sf_dir, "conversations").withColumn("upto", F.sum(ms).over(w))
    return rows.select(
        F.col("conv_id").cast("string").alias("call_id"),
        F.col("turn").cast("int").alias("seg_idx"),
        F.col("role").alias("speaker"),
        "text",
        (F.col("turn") % 3 == 2).alias("overlap"),
        ((F.col("upto") - ms).cast("double") / 1000).alias("start"),
        (F.col("upto").cast("double") / 1000).alias("end"),
    )


def event_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as turns of a user (call) and type (speaker); times in microseconds."""
    start = F.unix_micros(F.col("ts").cast("timestamp")).cast("double")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("call_id"),
        F.col("event_id").cast("int").alias("seg_idx"),
        F.col("event_type").alias("speaker"),
        F.col("event_type").alias("text"),
        (F.col("event_id") % 4 == 1).alias("overlap"),
        start.alias("start"),
        (start + F.round(F.col("value") * 1e6)).alias("end"),
    )


def event_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as speech regions of half an hour more, short ones a quarter of an hour late, numbered in order."""
    late = F.when(F.col("end") - F.col("start") < 20e6, HOUR / 4).otherwise(0.0)
    rows = event_segments(spark, sf_dir)
    w = Window.partitionBy("call_id", "speaker").orderBy("start", "seg_idx")
    return rows.select("call_id", "speaker", (F.row_number().over(w) - 1).alias("r_idx"), (F.col("start") + late).alias("s"), (F.col("end") + HOUR / 2).alias("e"))


_TOLD = T.StructType().add("word_idx", "integer").add("text", "string").add("start", "double").add("end", "double").add("score", "double")


@F.arrow_udf(T.ArrayType(_TOLD))
def read_aloud(words: pa.Array) -> pa.Array:
    """Words with times and scores: 60 ms a character, pauses and scores by place."""
    text, n = words.flatten(), pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.append(0, np.cumsum(n))
    place = np.arange(len(text)) - np.repeat(bounds[:-1], n)
    length = 60 * pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.append(0, np.cumsum(length + place * 37 % 11 * 80))
    upto = upto[1:] - np.repeat(upto[bounds[:-1]], n)
    fields = {"word_idx": place.astype(np.int32), "text": text, "start": (upto - length).astype(float), "end": upto.astype(float), "score": place * 7 % 10 / 10.0}
    told = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), told, mask=words.is_null())


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 16-bit signals."""
    pcm = F.transform("embedding", lambda x: F.round(x.cast("double") * 32767).cast("long"))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", pcm.alias("samples"))


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks with measures from their ids and sizes and signals from their labels.

    Every text is read whole; some documents have a twin with an id of its own and one letter as text, so
    that texts that are too short occur.
    """
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    twins = docs.where(F.col("doc_id") % 53 == 0).select((F.col("doc_id") + TWINS).alias("doc_id"), F.lit("x").alias("text"), "n_chars")
    part = lambda n, d: (F.col("doc_id") % n).cast("double") / d
    return docs.unionByName(twins).join(labels, "doc_id", "left").select(
        "doc_id",
        "text",
        "n_chars",
        F.lit(0.0).alias("start"),
        ((F.col("n_chars") % 400).cast("double") / 10).alias("end"),
        F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise((F.col("n_chars") % 390).cast("double") / 10).alias("clip_duration"),
        F.when(F.col("doc_id") % 7 != 0, part(10, 10)).alias("silence_ratio"),
        F.when(F.col("doc_id") % 11 != 0, (F.col("n_chars") % 350).cast("double") / 10).alias("chars_per_sec"),
        part(9, 8).alias("overlap_fraction"),
        (F.col("doc_id") % 4 == 0).alias("has_overlap"),
        F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("audio_quality"),
        F.col("quality").cast("double").alias("alignment_score"),
        F.when(F.col("doc_id") % 3 != 0, (1 - 0.5 * F.col("toxic")).cast("double")).alias("agreement_score"),
    )
