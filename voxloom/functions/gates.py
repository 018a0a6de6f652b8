"""Ordered gates and classes as CASE expressions; a null measure passes its gate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import Settings
from .text import script_ratio, strip


def effective_duration(start: str = "start", end: str = "end", clip: str = "clip_duration") -> Column:
    return F.coalesce(F.col(clip), F.greatest(F.lit(0.0), F.col(end) - F.col(start)))


def reject_reason(cfg: Settings, duration: Column, quality: Column | None = None, script: tuple[str, str] = ("0600", "06FF")) -> Column:
    """The first gate that a chunk fails, or null."""
    g, c = cfg.filt, cfg.chunk
    out = F.when(F.length("text") < g.min_chars, "too_short_text").when(duration < c.min_s, "under_min_duration").when(duration > c.max_s, "over_max_duration")
    if g.require_audio_quality_good and quality is not None:
        out = out.when((quality != "") & (quality != "good"), F.concat(F.lit("audio_quality:"), quality))
    return (
        out.when(F.col("silence_ratio") > g.max_silence_ratio, "too_silent")
        .when(F.col("chars_per_sec") < g.cps_min, "cps_too_low")
        .when(F.col("chars_per_sec") > g.cps_max, "cps_too_high")
        .when(script_ratio(F.col("text"), *script) < g.min_persian_char_ratio, "not_persian")
        .when(F.col("overlap_fraction") > cfg.overlap.drop_if_overlap_fraction_above, "excess_overlap")
    )


def chars_per_second(text: Column, duration: Column) -> Column:
    return F.try_divide(F.length(F.replace(text, F.lit(" "), F.lit(""))).cast("double"), F.when(duration > 0, duration))


def row_outcome(speaker: Column, text: Column, path: Column, keep_silence: bool = False) -> Column:
    """What becomes of a manifest row when the training table is made."""
    silent = F.lower(strip(F.coalesce(speaker, F.lit("")))) == "silence"
    return (
        F.when(silent & (not keep_silence), "dropped_silence")
        .when(strip(F.coalesce(text, F.lit(""))) == "", "missing_text")
        .when(path.isNull(), "missing_audio")
        .otherwise("kept")
    )


def length_bucket(cfg: Settings, d: Column) -> Column:
    c = cfg.chunk
    inside = lambda b: (d >= b[0]) & (d < b[1])
    return F.when(d < c.min_s, "under_min").when(d > c.max_s, "over_max").when(inside(c.short_band), "short").when(inside(c.mid_band), "mid").otherwise("long")


def duration_band(d: Column) -> Column:
    d = F.coalesce(d, F.lit(0.0))
    return F.when(d < 3, "<3s").when(d < 8, "3-8s").when(d < 18, "8-18s").when(d <= 28, "18-28s").otherwise(">28s")
