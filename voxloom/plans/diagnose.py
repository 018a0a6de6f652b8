"""Every intermediate of one call, as report tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio, text
from ..operators import reports
from ..scratch import materialize
from ..settings import Settings
from ..sources import writers
from ..sources.audio import Sound
from . import turn_path
from .plugins import Plugins


def channel_report(corpus: turn_path.Corpus, cfg: Settings) -> DataFrame:
    """Level of every channel and, for two, their correlation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["wav_path"], b["content"]):
                x, rate = audio.decode_wav(content)
                x = audio.resample(x, rate, cfg.audio.target_sr, cfg.audio.resampler)
                r = float(np.corrcoef(x)[0, 1]) if len(x) == 2 and x.shape[1] > 1 else float("nan")
                yield pd.DataFrame({"wav_path": path, "channel": range(len(x)), "level_db": [audio.level_db(c) for c in x], "correlation": r, "seconds": x.shape[1] / cfg.audio.target_sr})

    return corpus.recordings.mapInPandas(run, "wav_path string, channel int, level_db double, correlation double, seconds double")


def energy_report(corpus: turn_path.Corpus, cfg: Settings) -> DataFrame:
    """Share of a speaker's energy in every channel during that speaker's turns."""
    segs = corpus.segments.where("speaker <> ''").groupBy("call_id").agg(F.collect_list(F.struct("speaker", "start", "end")).alias("segs"))
    rows = turn_path.at_recordings(segs, corpus, None if corpus.opener else corpus.segments.count())
    opener = corpus.opener

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for call_id, path, content, segs in zip(b["call_id"], b["wav_path"], b["content"], b["segs"]):
                sound = Sound(path, content, cfg.audio.target_sr, cfg.audio.resampler, opener=opener)
                x = sound.channels
                sound.close()
                e = audio.energies(x, cfg.audio.target_sr, np.array([s["start"] for s in segs]), np.array([s["end"] for s in segs]))
                names = np.array([s["speaker"] for s in segs])
                for n in sorted(set(names)):
                    mine = e[names == n].sum(axis=0)
                    yield pd.DataFrame({"call_id": call_id, "speaker": n, "channel": range(len(x)), "share": mine / (mine.sum() + 1e-12)})

    return rows.select("call_id", "wav_path", "content", "segs").mapInPandas(run, "call_id string, speaker string, channel int, share double")


def chunk_report(judged: DataFrame) -> DataFrame:
    status = F.coalesce(F.concat(F.lit("DROP["), "reject_reason", F.lit("]")), F.lit("KEEP"))
    return judged.select(
        "call_id", "chunk_idx", status.alias("status"), "speaker", "channel", "start", "end", "clip_duration", "silence_ratio", "level_db", "chars_per_sec",
        F.size("segment_indices").alias("n_segments"), text.preview(F.col("text")).alias("preview"),
    )


def dump(judged: DataFrame, cfg: Settings, out: str) -> None:
    """Kept clips as a table of recordings, and their texts as lines, to check by ear."""
    name = F.format_string("chunk_%02d_%s.wav", F.col("chunk_idx"), F.col("speaker"))
    kept = judged.where("reject_reason is null").withColumn("audio_path", name)
    writers.clip_table(kept, cfg.audio.target_sr).write.mode("overwrite").parquet(f"{out}/clips")
    writers.write_lines(kept, F.concat_ws("\t", "audio_path", "text"), f"{out}/_text.tsv")


def run(spark: SparkSession, root: str, cfg: Settings = Settings(), plugins: Plugins = Plugins(), dump_to: str | None = None) -> dict[str, DataFrame]:  # noqa: B008
    """Report tables of the calls below a folder; clips and texts go to ``dump_to``."""
    corpus = turn_path.read_corpus(spark, root)
    heard = materialize(turn_path.listen(corpus, cfg, plugins), "heard")
    chunks = materialize(turn_path.build_chunks(corpus.segments.where("not bad_call"), heard.where("error is null"), cfg), "chunks")
    own = lambda df: turn_path.named(df, corpus).drop("pair", "clip_stem")
    judged = turn_path.judge(turn_path.render(chunks, corpus, cfg, plugins), corpus, cfg)
    if dump_to:
        dump(judged, cfg, dump_to)
    return {
        "turns": own(reports.turn_stats(corpus.segments, cfg.chunk.min_s)),
        "channels": channel_report(corpus, cfg),
        "mapping": own(heard.select("call_id", F.inline("mapping"))),
        "energy": own(energy_report(corpus, cfg)),
        "chunks": chunk_report(judged),
    }
