"""From call documents and recordings to a scored, tiered and split manifest.

Waveforms enter two Arrow functions, one before chunks exist (speech and channels) and one after
(clips); between them only intervals and text move.  Where tasks can open the recordings, the first reads each of them
once and the second only the bytes of its spans, so no waveform is ever shuffled or broadcast.  A call that can't be read becomes a row of
``skipped``; it never fails the job.

A call is a pair of files.  Ids of calls may repeat (every file may name the same request), so up to the
gates the key ``call_id`` is the document's path; ``named`` puts the calls' own ids back, which decide
the split and name the clips.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio, gates, scoring, text
from ..operators import manifest, reports, turns
from ..scratch import materialize
from ..settings import Settings
from ..sources import calls, writers
from ..sources.audio import Decoder, Opener, Sound, opener_for, read_recordings
from ..sources.clip_files import write_clip_files
from .plugins import Plugins, detector, score_column, transcript_column

#: Rows of spans that may be broadcast to where the recordings are read.
MAX_BROADCAST_SPANS = 500_000


@dataclass
class Corpus:
    """Calls with their documents, turns, recordings and the pairs of files behind them.

    ``calls`` has the pair's key (``call_id``), the call's own id (``name``) and the stem of its clips, which
    is that id, with a mark of the pair where ids repeat.
    """

    calls: DataFrame
    segments: DataFrame
    recordings: DataFrame
    pairs: DataFrame
    opener: Opener | None = None


def _plain(path):
    """One form for the local paths that different readers give."""
    return F.regexp_replace(path, "^file:/+", "/")


def read_corpus(spark: SparkSession, root: str, limit: int = 0) -> Corpus:
    js, wav = calls.list_files(spark, root, ".json"), read_recordings(spark, root)
    paths = js.unionByName(wav.select("path")).select(_plain("path").alias("path"))
    pairs = calls.pair_files(paths)
    good = calls.first_calls(pairs.where("skip_reason is null"), limit)
    docs = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root, wholetext=True)
    docs = docs.select(_plain("_metadata.file_path").alias("json_path"), F.try_parse_json("value").alias("call"))
    stem = F.regexp_extract("wav_path", r"([^/]*)\.[^./]*$", 1)
    rows = good.join(docs, "json_path").withColumn("name", F.coalesce(calls.call_id(F.col("call"), stem), stem))
    shared = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name", F.lit(True).alias("shared"))
    mark = F.when(F.col("shared"), F.concat(F.lit("_"), F.substring(F.md5("json_path"), 1, 8))).otherwise("")
    rows = rows.join(shared, "name", "left").select(
        F.col("json_path").alias("call_id"),
        "name",
        F.concat(text.safe_id(F.col("name")), mark).alias("clip_stem"),
        "json_path",
        "wav_path",
        "call",
        calls.audio_quality(F.col("call")).alias("audio_quality"),
    )
    return Corpus(rows, calls.segments(rows.where("call is not null")), wav.select(_plain("path").alias("wav_path"), "content"), pairs, opener_for(root))


def named(rows: DataFrame, corpus: Corpus) -> DataFrame:
    """Rows with the calls' own ids in ``call_id``, the pair in ``pair``, and the stem of clips."""
    names = corpus.calls.select("call_id", "name", "clip_stem")
    return rows.join(names, "call_id").withColumnRenamed("call_id", "pair").withColumnRenamed("name", "call_id")


def at_recordings(rows: DataFrame, corpus: Corpus, n_spans: int | None = None) -> DataFrame:
    """Rows of calls with their recordings (``wav_path``, ``content``).

    Tasks that can open the recordings get rows without content, dealt by call.  Otherwise up to ``MAX_BROADCAST_SPANS``
    spans (``n_spans`` is their counted number) go to where Spark reads the recordings; more of them meet in a shuffle.
    """
    spans = corpus.calls.select("call_id", "wav_path").join(rows, "call_id")
    if corpus.opener:
        # a row of few bytes stands for minutes of sound, so the number of tasks mustn't follow the bytes
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return spans.repartition(tasks, "call_id").withColumn("content", F.lit(None).cast("binary"))
    return corpus.recordings.join(F.broadcast(spans) if n_spans is not None and n_spans <= MAX_BROADCAST_SPANS else spans, "wav_path")


def _listen(cfg: Settings, plugins: Plugins | None, decoder: Decoder, opener: Opener | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vad = detector(plugins.vad) if plugins else lambda c, rate: ()
        for b in batches:
            for call_id, path, content, segs in zip(b["call_id"], b["wav_path"], b["content"], b["segs"]):
                rate = cfg.audio.target_sr
                sound = Sound(path, content, rate, cfg.audio.resampler, decoder, opener)
                try:
                    x = sound.channels
                    names = [s["speaker"] for s in segs]
                    if len(x) == 1:
                        mapping = dict.fromkeys(names, 0)
                    else:
                        e = audio.energies(x, rate, np.array([s["start"] for s in segs]), np.array([s["end"] for s in segs]))
                        mapping = audio.assign_channels({n: e[[k for k, v in enumerate(names) if v == n]].sum(axis=0) for n in sorted(set(names)) if n})
                    regions = [[{"s": float(s), "e": float(t)} for s, t in vad(c, rate)] for c in x]
                    row = {"mapping": [{"speaker": n, "channel": c} for n, c in mapping.items()], "regions": regions, "error": None}
                except Exception as err:  # noqa: BLE001  a bad recording is a row, not a failed job
                    row = {"mapping": [], "regions": [], "error": str(err)[:300] or type(err).__name__}
                finally:
                    sound.close()
                yield pd.DataFrame([{"call_id": call_id, **row}])

    return run


def listen(corpus: Corpus, cfg: Settings, plugins: Plugins | None, decoder: Decoder = audio.decode_wav) -> DataFrame:
    """(call_id, mapping, regions by channel, error) of every call with usable turns; without plugins no speech is looked for."""
    good = corpus.segments.where("not bad_call").groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("seg_idx", "speaker", "start", "end"))).alias("segs"))
    rows = at_recordings(good, corpus, None if corpus.opener else corpus.segments.count()).select("call_id", "wav_path", "content", "segs")
    kind = "call_id string, mapping array<struct<speaker:string,channel:int>>, regions array<array<struct<s:double,e:double>>>, error string"
    return rows.mapInPandas(_listen(cfg, plugins, decoder, corpus.opener), kind)


def build_chunks(segments: DataFrame, heard: DataFrame, cfg: Settings) -> DataFrame:
    """Chunks of the heard calls, numbered within their call in order of speaker, group and piece."""
    segments = segments.join(heard.select("call_id"), "call_id", "left_semi")
    mapping = heard.select("call_id", F.inline("mapping"))
    regions = heard.select("call_id", F.posexplode("regions").alias("channel", "regions"))
    grouped = turns.assign_groups_streaming(segments, cfg)
    order = turns.usable(segments).groupBy("call_id", "speaker").agg(F.min("seg_idx").alias("speaker_ord"))
    groups = turns.collect_groups(grouped).join(mapping, ["call_id", "speaker"], "left").withColumn("channel", F.coalesce("channel", F.lit(0)))
    pieces = turns.split_groups(groups, regions, cfg, ["call_id", "channel"]).join(order, ["call_id", "speaker"])
    place = F.row_number().over(turns.Window.partitionBy("call_id").orderBy("speaker_ord", "group_idx", "piece_idx")) - 1
    return pieces.withColumn("chunk_idx", place.cast("int")).drop("speaker_ord", "group_idx", "piece_idx")


def _render(cfg: Settings, decoder: Decoder, trim: bool, plugins: Plugins, opener: Opener | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rate = cfg.audio.target_sr
        vad = detector(plugins.vad)
        for b in batches:
            for call_id, path, content, spans in zip(b["call_id"], b["wav_path"], b["content"], b["spans"]):
                sound = Sound(path, content, rate, cfg.audio.resampler, decoder, opener)
                rows = []
                for s in spans:
                    clip = sound.cut(s["channel"], s["start"], s["end"], cfg.audio.edge_pad_s)
                    regions = vad(clip, rate)
                    if trim and len(regions):
                        clip = audio.cut(clip, rate, max(0.0, regions[0][0] - cfg.chunk.trim_margin_s), regions[-1][1] + cfg.chunk.trim_margin_s, 0.0)
                        regions = vad(clip, rate)
                    spoken = float(sum(e - a for a, e in regions))
                    seconds = len(clip) / rate
                    silent = max(0.0, 1.0 - spoken / seconds) if seconds else 1.0
                    pcm = np.clip(np.rint(clip * 32767), -32768, 32767).astype("<i2").tobytes()
                    rows.append((call_id, s["chunk_idx"], seconds, silent, audio.level_db(clip), pcm))
                sound.close()
                yield pd.DataFrame(rows, columns=["call_id", "chunk_idx", "clip_duration", "silence_ratio", "level_db", "samples"])

    return run


def render(chunks: DataFrame, corpus: Corpus, cfg: Settings, plugins: Plugins, decoder: Decoder = audio.decode_wav, trim: bool = True) -> DataFrame:
    """Chunks with the measures and samples of their clips."""
    spans = chunks.groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("chunk_idx", "channel", "start", "end"))).alias("spans"))
    rows = at_recordings(spans, corpus, None if corpus.opener else chunks.count()).select("call_id", "wav_path", "content", "spans")
    kind = "call_id string, chunk_idx int, clip_duration double, silence_ratio double, level_db double, samples binary"
    clips = rows.mapInPandas(_render(cfg, decoder, trim, plugins, corpus.opener), kind)
    out = chunks.join(clips, ["call_id", "chunk_idx"])
    return out.withColumn("chars_per_sec", gates.chars_per_second(F.col("text"), F.col("clip_duration")))


def judge(rendered: DataFrame, corpus: Corpus, cfg: Settings) -> DataFrame:
    """Clips with the first gate that each fails; from here on ``call_id`` is the call's own id."""
    quality = corpus.calls.select("call_id", "audio_quality")
    rows = named(rendered.join(quality, "call_id"), corpus)
    return rows.withColumn("reject_reason", gates.reject_reason(cfg, F.col("clip_duration"), F.col("audio_quality")))


def clip_path(cfg: Settings, folder: str):
    return F.format_string(f"{folder}/%s_ch%d_%03d.wav", F.col("clip_stem"), F.col("channel"), F.col("chunk_idx"))


def score(judged: DataFrame, cfg: Settings, plugins: Plugins, folder: str = "audio") -> DataFrame:
    """Kept chunks with scores; models see only what the gates let through."""
    rate = cfg.audio.target_sr
    kept = judged.where("reject_reason is null")
    kept = kept.withColumn("alignment_score", score_column(plugins.scorer if cfg.align.enabled else None, "text", "samples", rate))
    kept = kept.withColumn("second_asr_text", transcript_column(plugins.transcriber if cfg.second_asr.enabled else None, "samples", rate, cfg.second_asr.batch_size))
    if plugins.transcriber and cfg.second_asr.enabled:
        kept = kept.withColumn("agreed", text.agreement(F.col("text"), F.col("second_asr_text")))
        kept = kept.withColumns({"agreement_score": F.col("agreed.score"), "disagreements": F.col("agreed.missed")}).drop("agreed")
    else:
        kept = kept.withColumns({"agreement_score": F.lit(None).cast("double"), "disagreements": F.array().cast("array<string>")})
    c = scoring.confidence(cfg, F.col("alignment_score"), F.col("agreement_score"), F.col("overlap_fraction"), F.col("chars_per_sec"))
    kept = kept.withColumn("confidence", c)
    return kept.withColumns({"tier": scoring.tier(cfg, F.col("confidence")), "loss_weight": scoring.loss_weight(cfg, F.col("confidence")), "audio_path": clip_path(cfg, folder)})


MANIFEST = [
    "call_id", "channel", "speaker", "start", "end", "text", "segment_indices", "clip_duration", "has_overlap", "overlap_fraction", "silence_ratio", "chars_per_sec",
    "alignment_score", "agreement_score", "confidence", "second_asr_text", "tier", "loss_weight", "audio_path", "duration", "extent",
]


def write_corpus(records: DataFrame, gold: DataFrame | None, cfg: Settings, out: str) -> None:
    """Train, test and review manifests from records with ``split``; review rows are in the others too."""
    plain = [c for c in MANIFEST if c in records.columns]
    train = records.where("split = 'train'").select(*plain)
    writers.write_jsonl(manifest.merge_gold(train, gold, cfg) if gold is not None else train, f"{out}/train.jsonl")
    writers.write_jsonl(records.where("split = 'test'").select(*plain), f"{out}/test.jsonl")
    writers.write_jsonl(records.where("tier = 'review'").select(*plain), f"{out}/review_queue.jsonl")


def skipped_calls(corpus: Corpus, heard: DataFrame) -> DataFrame:
    """(wav_path, reason) of calls that couldn't be read; documents without a recording make no call, see ``Corpus.pairs``."""
    unreadable = corpus.calls.where("call is null").select("wav_path", F.lit("unreadable document").alias("reason"))
    bad = corpus.segments.where("bad_call").select("call_id").distinct().join(corpus.calls, "call_id").select("wav_path", F.lit("turn without times").alias("reason"))
    deaf = heard.where("error is not null").join(corpus.calls, "call_id").select("wav_path", F.col("error").alias("reason"))
    return unreadable.unionByName(bad).unionByName(deaf)


def run(spark: SparkSession, root: str, out: str, cfg: Settings = Settings(), plugins: Plugins = Plugins(), gold: str | None = None, decoder: Decoder = audio.decode_wav, files: bool = False) -> DataFrame:  # noqa: B008
    """The whole path; returns the one-row statistics that it also writes.

    Turns, what was heard, and chunks are written before they are read more than once, and rendered chunks
    (``clips``) are what everything after reads, so that no recording is decoded again for a count.  The
    kept clips lie in ``recordings`` as a table (path, bytes), under the paths that the manifests name, and with ``files`` at these
    paths themselves.
    """
    corpus = read_corpus(spark, root)
    manifest.check_split(corpus.calls.count(), cfg)
    corpus.segments = materialize(corpus.segments, "turns")
    heard = materialize(listen(corpus, cfg, plugins, decoder), "heard")
    chunks = materialize(build_chunks(corpus.segments.where("not bad_call"), heard.where("error is null"), cfg), "chunks")
    judge(render(chunks, corpus, cfg, plugins, decoder, cfg.chunk.trim_silence_edges), corpus, cfg).write.mode("overwrite").parquet(f"{out}/clips")
    judged = spark.read.parquet(f"{out}/clips")
    kept = judged.where("reject_reason is null").withColumn("audio_path", clip_path(cfg, f"{out}/audio"))
    writers.clip_table(kept, cfg.audio.target_sr).write.mode("overwrite").parquet(f"{out}/recordings")
    if files:
        write_clip_files(spark.read.parquet(f"{out}/recordings"), out)
    score(judged, cfg, plugins, f"{out}/audio").drop("samples").write.mode("overwrite").parquet(f"{out}/scored")
    scored = spark.read.parquet(f"{out}/scored")
    capped = manifest.cap_overlap(scored, cfg, [calls.path_order("pair"), "chunk_idx"])  # equal confidences go in order of the pairs
    records = manifest.split_by_call(manifest.to_records(capped), manifest.test_calls(capped, cfg))
    write_corpus(records, spark.read.json(gold) if gold else None, cfg, out)
    skipped = skipped_calls(corpus, heard)
    writers.write_lines(skipped, writers.skipped_line(), f"{out}/skipped_calls.txt")
    flags = corpus.calls.join(skipped.select("wav_path").distinct().withColumn("gone", F.lit(True)), "wav_path", "left").select(F.coalesce("gone", F.lit(False)).alias("skipped"))
    stats = reports.build_stats(judged, records, flags)
    writers.write_stats(stats, f"{out}/build_stats")
    return spark.read.schema(stats.schema).json(f"{out}/build_stats")
