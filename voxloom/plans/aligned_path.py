"""The path that takes word times from an aligner instead of the transcript's turn times."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio, gates, scoring
from ..operators import manifest, reports, turns
from ..scratch import materialize
from ..settings import Settings
from ..sources import writers
from ..sources.audio import Decoder, Sound
from ..sources.clip_files import write_clip_files
from . import turn_path
from .plugins import Plugins, aligned_words


def speaker_texts(corpus: turn_path.Corpus, heard: DataFrame) -> DataFrame:
    """(call_id, speaker, channel, ref_text) of the heard calls: each speaker's turns in order as one text."""
    rows = turns.turns_by_speaker(corpus.segments.where("not bad_call").join(heard.select("call_id"), "call_id", "left_semi"))
    joined = F.trim(F.array_join(F.transform("turns", lambda t: t["text"]), " "))
    mapping = heard.select("call_id", F.inline("mapping"))
    return rows.select("call_id", "speaker", joined.alias("ref_text")).join(mapping, ["call_id", "speaker"], "left").withColumn("channel", F.coalesce("channel", F.lit(0)))


def _by_call(texts: DataFrame, corpus: turn_path.Corpus) -> DataFrame:
    """(call_id, wav_path, content, clip_stem, speakers): the speakers of each call, beside its recording."""
    speakers = texts.groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("speaker", "channel", "ref_text"))).alias("speakers"))
    rows = turn_path.at_recordings(speakers, corpus, None if corpus.opener else texts.count())
    return rows.join(corpus.calls.select("call_id", "clip_stem"), "call_id").select("call_id", "wav_path", "content", "clip_stem", "speakers")


def prepared(texts: DataFrame, corpus: turn_path.Corpus, cfg: Settings, folder: str, decoder: Decoder = audio.decode_wav) -> DataFrame:
    """(path, bytes, text_path, text): each speaker's channel as a recording beside the reference text."""
    rate, opener = cfg.audio.target_sr, corpus.opener

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content, stem, speakers in zip(b["wav_path"], b["content"], b["clip_stem"], b["speakers"]):
                sound = Sound(path, content, rate, cfg.audio.resampler, decoder, opener)
                names = [f"{folder}/{stem}_{s['speaker']}" for s in speakers]
                clips = [audio.encode_wav(sound.channels[s["channel"]], rate) for s in speakers]
                sound.close()
                yield pd.DataFrame({"path": [f"{n}.wav" for n in names], "bytes": clips, "text_path": [f"{n}.txt" for n in names], "text": [s["ref_text"] for s in speakers]})

    return _by_call(texts, corpus).mapInPandas(run, "path string, bytes binary, text_path string, text string")


def align(texts: DataFrame, corpus: turn_path.Corpus, cfg: Settings, plugins: Plugins, decoder: Decoder = audio.decode_wav) -> DataFrame:
    """(call_id, speaker, channel, words, error) from the word aligner, without low words at either end.

    A recording is decoded where its speakers are aligned, so that only words leave the task.
    """
    rate, opener, load = cfg.audio.target_sr, corpus.opener, plugins.word_aligner

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for b in batches:
            for call_id, path, content, speakers in zip(b["call_id"], b["wav_path"], b["content"], b["speakers"]):
                sound, rows = Sound(path, content, rate, cfg.audio.resampler, decoder, opener), []
                for s in speakers:
                    words, error = aligned_words(model, lambda c=s["channel"]: sound.channels[c], rate, s["ref_text"])
                    rows.append((call_id, s["speaker"], s["channel"], words, error))
                sound.close()
                yield pd.DataFrame(rows, columns=["call_id", "speaker", "channel", "words", "error"])

    kind = "call_id string, speaker string, channel int, words array<struct<text:string,start:double,end:double,score:double>>, error string"
    out = _by_call(texts, corpus).mapInPandas(run, kind)
    return out.withColumn("words", turns.trim_edge_words(F.col("words"), cfg.forced_align.min_word_score))


def build_chunks(aligned: DataFrame, cfg: Settings) -> DataFrame:
    chunks = turns.chunk_words(aligned.where("error is null"), cfg, ["call_id", "speaker", "channel"])
    # chunks are numbered per speaker for file names, per call for rendering
    place = F.row_number().over(turns.Window.partitionBy("call_id").orderBy("speaker", "chunk_idx")) - 1
    empty = {"segment_indices": F.array().cast("array<int>"), "has_overlap": F.lit(False), "overlap_fraction": F.lit(0.0)}
    return chunks.withColumns({"speaker_chunk": F.col("chunk_idx"), **empty}).withColumn("chunk_idx", place.cast("int"))


def run(spark: SparkSession, root: str, out: str, plugins: Plugins, cfg: Settings = Settings(), gold: str | None = None, limit: int = 0, keep_prepared: bool = False, decoder: Decoder = audio.decode_wav, files: bool = False) -> DataFrame:  # noqa: B008
    """The whole path; returns the one-row statistics.  A call whose alignment fails is skipped with its reason."""
    if plugins.word_aligner is None:
        raise ValueError("the aligned path needs a word aligner")
    corpus = turn_path.read_corpus(spark, root, limit)
    n_calls = corpus.calls.count()
    manifest.check_split(n_calls, cfg)
    corpus.segments = materialize(corpus.segments, "turns")
    heard = materialize(turn_path.listen(corpus, cfg, None, decoder), "heard")
    texts = speaker_texts(corpus, heard.where("error is null"))
    if keep_prepared:
        prepared(texts, corpus, cfg, f"{out}/prep", decoder).write.mode("overwrite").parquet(f"{out}/prepared")
        if files:
            prep = spark.read.parquet(f"{out}/prepared")
            lines = prep.select(F.col("text_path").alias("path"), F.encode("text", "UTF-8").alias("bytes"))
            write_clip_files(prep.select("path", "bytes").unionByName(lines), out)
    align(texts, corpus, cfg, plugins, decoder).write.mode("overwrite").parquet(f"{out}/words")
    aligned = spark.read.parquet(f"{out}/words")
    failed = aligned.where("error is not null").groupBy("call_id").agg(F.min("error").alias("reason"))
    aligned = aligned.join(failed.select("call_id"), "call_id", "left_anti")

    chunks = materialize(build_chunks(aligned, cfg), "chunks")
    rendered = turn_path.named(turn_path.render(chunks, corpus, cfg, plugins, decoder, trim=False), corpus).drop("silence_ratio")
    path = F.format_string(f"{out}/audio/%s_%s_%03d.wav", F.col("clip_stem"), F.col("speaker"), F.col("speaker_chunk"))
    rendered = rendered.withColumns({"tier": scoring.tier(cfg, F.col("confidence")), "loss_weight": scoring.loss_weight(cfg, F.col("confidence")), "audio_path": path})
    rendered.write.mode("overwrite").parquet(f"{out}/clips")
    short = gates.effective_duration() < cfg.chunk.min_s
    whole = spark.read.parquet(f"{out}/clips")
    writers.clip_table(whole.where(~short), cfg.audio.target_sr).write.mode("overwrite").parquet(f"{out}/recordings")
    if files:
        write_clip_files(spark.read.parquet(f"{out}/recordings"), out)
    clips = whole.drop("samples")
    kept = clips.where(~short)
    records = manifest.split_by_call(manifest.to_records(kept), manifest.test_calls(kept, cfg))
    turn_path.write_corpus(records, spark.read.json(gold) if gold else None, cfg, out)
    writers.write_clip_list(records, f"{out}/clips.tsv")
    skipped = turn_path.skipped_calls(corpus, heard).unionByName(failed.join(corpus.calls, "call_id").select("wav_path", "reason"))
    writers.write_lines(skipped, writers.skipped_line(reason="reason"), f"{out}/skipped_calls.txt")

    tiers = reports.as_map(reports.tier_counts(records), "tier").withColumnRenamed("counts", "tiers").withColumn("one", F.lit(1))
    gone = skipped.agg(F.count_distinct("wav_path").alias("calls_skipped")).withColumn("calls", F.lit(n_calls).cast("long")).withColumn("one", F.lit(1))
    counts = records.agg(
        F.count(F.lit(1)).alias("chunks"), F.count(F.lit(1)).alias("chunks_kept"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"), F.count_if(F.col("tier") == "review").alias("review_queue")
    ).withColumn("one", F.lit(1))
    dropped = clips.agg(F.count_if(short).alias("dropped_short")).withColumn("one", F.lit(1))
    stats = counts.join(tiers, "one").join(dropped, "one").join(gone, "one").drop("one")
    writers.write_stats(stats, f"{out}/build_stats")
    return spark.read.schema(stats.schema).json(f"{out}/build_stats")
