"""Confidence, tier and loss weight as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import Settings


def clamp(c: Column) -> Column:
    """Between 0 and 1; null stays null, which least() and greatest() alone would lose."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def penalty(cfg: Settings, overlap: Column, cps: Column) -> Column:
    crosstalk = F.when(overlap != 0, F.greatest(F.lit(0.4), F.lit(1.0) - overlap)).otherwise(F.lit(1.0))
    pace = F.when((cps < cfg.filt.cps_min) | (cps > cfg.filt.cps_max), F.lit(0.6)).otherwise(F.lit(1.0))
    return crosstalk * pace


def confidence(cfg: Settings, align: Column, agree: Column, overlap: Column, cps: Column) -> Column:
    """Weighted mean of the signals that are there (0.5 without any), times the penalty."""
    pairs = [(cfg.confidence.w_align, align), (cfg.confidence.w_agree, agree)]
    total = sum((F.coalesce(F.lit(w) * clamp(s), F.lit(0.0)) for w, s in pairs), F.lit(0.0))
    weight = sum((F.when(s.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for w, s in pairs), F.lit(0.0))
    return clamp(F.coalesce(F.try_divide(total, weight), F.lit(0.5)) * penalty(cfg, overlap, cps))


def tier(cfg: Settings, c: Column) -> Column:
    c = F.coalesce(c, F.lit(0.0))
    return F.when(c >= cfg.confidence.accept_at, "accept").when(c >= cfg.confidence.review_below, "downweight").otherwise("review")


def loss_weight(cfg: Settings, c: Column) -> Column:
    c = F.coalesce(c, F.lit(0.0))
    return F.when(c >= cfg.confidence.accept_at, 1.0).when(c >= cfg.confidence.review_below, cfg.confidence.downweight_loss).otherwise(0.0)
