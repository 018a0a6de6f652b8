"""Corpus assembly: overlap cap, split by call, gold mix, records."""

from __future__ import annotations

import random
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.gates import effective_duration
from ..functions.numbers import python_round
from ..settings import Settings
from .ranking import global_rank


def cap_overlap(chunks: DataFrame, cfg: Settings, order: list[str | Column]) -> DataFrame:
    """Clean chunks, and of those with overlap the most confident up to a share of all (``order`` breaks ties).

    The cap grows with the corpus, so the k best come from ranks over key ranges rather than from a
    sort with a limit, which would pass them through the driver.
    """
    clean = chunks.where(~F.col("has_overlap"))
    if not cfg.overlap.keep:
        return clean
    total, crossed = chunks.agg(F.count(F.lit(1)), F.count_if("has_overlap")).first()
    cap = int(cfg.overlap.max_fraction_of_dataset * total)
    if crossed <= cap:
        return chunks
    keys = [F.coalesce("confidence", F.lit(0.0)).desc(), *((F.col(c) if isinstance(c, str) else c).asc() for c in order)]
    best = global_rank(chunks.where("has_overlap"), keys, "overlap_rank")
    return clean.unionByName(best.where(F.col("overlap_rank") < cap).drop("overlap_rank"))


def n_test(n_calls: int, cfg: Settings) -> int:
    return max(1, int(n_calls * cfg.split.test_fraction)) if n_calls else 0


def test_calls_by_hash(chunks: DataFrame, cfg: Settings, call: str = "call_id") -> DataFrame:
    """The test calls: first in order of a seeded digest."""
    calls = chunks.select(call).distinct()
    key = F.md5(F.concat(F.col(call).cast("string"), F.lit(f":{cfg.split.seed}")))
    ranked = global_rank(calls, [key.asc(), F.col(call).asc()], "call_rank")
    return ranked.where(F.col("call_rank") < n_test(calls.count(), cfg)).drop("call_rank")


#: Most calls whose places may be shuffled on the driver: 8 bytes each.
MAX_SHUFFLED_CALLS = 50_000_000


def test_calls_by_shuffle(chunks: DataFrame, cfg: Settings, call: str = "call_id") -> DataFrame:
    """The test calls as Python's seeded shuffle of the sorted ids gives them.

    The shuffle is sequential, so it is done on the driver, but on places in the sorted order only; the ids stay
    where they are and meet the chosen places by their ranks.  For more than ``MAX_SHUFFLED_CALLS`` use the digest.
    """
    calls = chunks.select(call).distinct()
    ranked = global_rank(calls, [F.col(call).asc()], "call_rank")
    n = ranked.count()
    if n > MAX_SHUFFLED_CALLS:
        raise ValueError(f"more than {MAX_SHUFFLED_CALLS} calls; split by digest instead")
    places = array("q", range(n))
    random.Random(cfg.split.seed).shuffle(places)
    chosen = pd.DataFrame({"call_rank": np.frombuffer(places, np.int64)[: n_test(n, cfg)]})
    picked = chunks.sparkSession.createDataFrame(chosen, "call_rank long")
    return ranked.join(picked, "call_rank", "left_semi").select(call)


def check_split(n_calls: int, cfg: Settings) -> None:
    """Raises before any work where the split at its end couldn't be made."""
    if cfg.split.method not in ("shuffle", "digest"):
        raise ValueError(f"split.method is {cfg.split.method!r}; it may be 'shuffle' or 'digest'")
    if cfg.split.method == "shuffle" and n_calls > MAX_SHUFFLED_CALLS:
        raise ValueError(f"{n_calls} calls are more than a seeded shuffle may bring to the driver; set split.method to 'digest'")


def test_calls(chunks: DataFrame, cfg: Settings, call: str = "call_id") -> DataFrame:
    """The test calls by the method that the settings name."""
    return (test_calls_by_hash if cfg.split.method == "digest" else test_calls_by_shuffle)(chunks, cfg, call)


def split_by_call(chunks: DataFrame, test_calls: DataFrame, call: str = "call_id") -> DataFrame:
    """Chunks with ``split``; every call is wholly on one side."""
    marked = test_calls.select(call, F.lit("test").alias("split"))
    return chunks.join(marked, call, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def merge_gold(train: DataFrame, gold: DataFrame, cfg: Settings) -> DataFrame:
    """Train rows and each gold row as often as asked for, marked as gold."""
    weight = F.coalesce(F.col("loss_weight").cast("double"), F.lit(1.0)) if "loss_weight" in gold.columns else F.lit(1.0)
    copies = F.explode(F.sequence(F.lit(1), F.lit(max(1, cfg.split.gold_oversample))))
    rows = gold.withColumns({"tier": F.lit("gold"), "loss_weight": weight, "source": F.lit("gold")}).withColumn("copy", copies).drop("copy")
    return train.unionByName(rows, allowMissingColumns=True)


def to_records(chunks: DataFrame) -> DataFrame:
    """Chunks with ``duration`` and ``extent`` in milliseconds' precision."""
    d = effective_duration() if "clip_duration" in chunks.columns else F.greatest(F.lit(0.0), F.col("end") - F.col("start"))
    return chunks.withColumns({"duration": python_round(d, 3), "extent": F.array(python_round(F.col("start"), 3), python_round(F.col("end"), 3))})
