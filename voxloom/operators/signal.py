"""Signal measures as relations: a signal is a row with an array of integer samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ctc


def frame_energy(signals: DataFrame, samples: str, frame: int, keys: list[str]) -> DataFrame:
    """(keys, frame_idx, energy): sums of squares of whole frames; a ragged tail is ignored."""
    n = F.floor(F.size(samples) / F.lit(frame)).cast("int")
    square = lambda i: F.aggregate(F.slice(samples, i * frame + 1, frame), F.lit(0).cast("long"), lambda a, v: a + v * v)
    frames = F.transform(F.sequence(F.lit(0), n - 1), square)
    return signals.where(n > 0).select(*keys, F.posexplode(frames).alias("frame_idx", "energy"))


def speech_regions(frames: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """(keys, r_idx, s, e) in frames: runs of frames above the threshold, as gaps and islands."""
    active = frames.where(F.col("energy") > threshold)
    island = F.col("frame_idx") - F.row_number().over(Window.partitionBy(*keys).orderBy("frame_idx"))
    runs = active.withColumn("island", island).groupBy(*keys, "island").agg(F.min("frame_idx").alias("s"), (F.max("frame_idx") + 1).alias("e"))
    return runs.withColumn("r_idx", F.row_number().over(Window.partitionBy(*keys).orderBy("s")) - 1).drop("island")


def silence_ratio(regions: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Share of ``total`` outside the regions, floored at 0; 1 for an empty signal."""
    spoken = regions.groupBy(*keys).agg(F.sum(F.col("e") - F.col("s")).alias("spoken"))
    share = F.greatest(F.lit(0.0), 1.0 - F.try_divide(F.coalesce("spoken", F.lit(0)).cast("double"), F.col("total").cast("double")))
    return totals.join(spoken, keys, "left").select(*keys, F.coalesce(share, F.lit(1.0)).alias("silence_ratio"))


def silence_gaps(regions: DataFrame, totals: DataFrame, keys: list[str], least: float) -> DataFrame:
    """(keys, gap_start, gap_end) of silences of ``least`` or more, leading and trailing ones too."""
    w = Window.partitionBy(*keys).orderBy("s")
    before = regions.select(*keys, F.lag("e", 1, 0).over(w).alias("gap_start"), F.col("s").alias("gap_end"))
    ends = regions.groupBy(*keys).agg(F.max_by("e", "s").alias("e"))
    tail = totals.join(ends, keys, "left").select(*keys, F.coalesce("e", F.lit(0)).alias("gap_start"), F.col("total").alias("gap_end"))
    return before.unionByName(tail).where(F.col("gap_end") - F.col("gap_start") >= least)


def level_db(samples: Column) -> Column:
    """20 log10 of the root mean square; minus infinity for an empty signal."""
    mean = F.aggregate(samples, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")) / F.size(samples)
    return F.when(F.size(samples) == 0, F.lit(float("-inf"))).otherwise(20 * F.log10(F.sqrt(mean + 1e-12) + 1e-12))


def correlation(pairs: DataFrame, a: str, b: str, keys: list[str]) -> DataFrame:
    """Pearson correlation of two arrays over their common length; NaN for one sample or none."""
    n = F.least(F.size(a), F.size(b))
    both = pairs.select(*keys, F.explode_outer(F.arrays_zip(F.slice(a, 1, n).alias("x"), F.slice(b, 1, n).alias("y"))).alias("v"))
    return both.groupBy(*keys).agg(F.when(F.count("v") > 1, F.corr("v.x", "v.y")).otherwise(F.lit(float("nan"))).alias("correlation"))


def energy_share(energy: DataFrame, keys: list[str], value: str = "energy") -> DataFrame:
    """Each row's share of the energy of its keys."""
    return energy.withColumn("share", F.col(value) / (F.sum(value).over(Window.partitionBy(*keys)) + 1e-12))


def assign_channels(energy: DataFrame) -> DataFrame:
    """(call_id, speaker, channel): greedy over the speakers of a call, loudest first.

    ``energy`` has a row a (call_id, speaker, channel); a call has a handful.  The speakers' order and
    their ranked channels are window functions; the taking is a fold over the call's speakers.
    """
    ranked = energy.groupBy("call_id", "speaker").agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("energy")).alias("loss"), "channel"))), lambda x: x["channel"]).alias("ranked"), F.max("energy").alias("peak")
    )
    calls = ranked.groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("peak")).alias("loss"), "speaker", "ranked"))).alias("speakers"))

    def take(done: Column, s: Column) -> Column:
        used = F.transform(done, lambda d: d["channel"])
        free = F.filter(s["ranked"], lambda c: ~F.array_contains(used, c))
        mine = F.coalesce(F.try_element_at(free, F.lit(1)), F.element_at(s["ranked"], 1))
        return F.concat(done, F.array(F.struct(s["speaker"].alias("speaker"), mine.alias("channel"))))

    empty = F.array().cast("array<struct<speaker:string,channel:int>>")
    return calls.select("call_id", F.inline(F.aggregate("speakers", empty, take)))


def with_channel(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows with their speaker's channel, 0 where the mapping has none."""
    return rows.join(mapping, ["call_id", "speaker"], "left").withColumn("channel", F.coalesce("channel", F.lit(0)))


def ctc_path(emissions: Column, outputs: Column, n_outputs: int, blank: int = 0) -> Column:
    """(score, first, end): the best path of a row of outputs through emissions (frames of ``n_outputs`` log
    probabilities one after another) and the frames of each output; null where the frames can't hold them.
    """

    @F.pandas_udf("score double, first array<int>, end array<int>")
    def run(matrices: pd.Series, rows: pd.Series) -> pd.DataFrame:
        found = []
        for flat, row in zip(matrices, rows):
            try:
                trellis = ctc.Trellis(np.asarray(flat, float).reshape(-1, n_outputs), list(row), blank)
                path, score = ctc.best_path(trellis)
                place = ctc.spans(path, len(row))
                found.append((score, place[:, 0].tolist(), place[:, 1].tolist()))
            except (TypeError, ValueError):
                found.append((None, None, None))
        return pd.DataFrame(found, columns=["score", "first", "end"])

    return run(emissions, outputs)
