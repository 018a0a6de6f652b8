"""Turns as a stream.  An extension: the batch operators are the measure of its results."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..settings import Settings


def gap_sessions(turns: DataFrame, gap: str, lateness: str) -> DataFrame:
    """Groups broken by gaps alone: session windows over (call_id, speaker, ts, text), closed by the watermark."""
    rows = turns.withWatermark("ts", lateness)
    window = F.session_window("ts", gap)
    return rows.groupBy("call_id", "speaker", window).agg(F.count(F.lit(1)).alias("n_turns"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def group_turns(turns: DataFrame, cfg: Settings) -> DataFrame:
    """Greedy groups of turns that arrive in order of start within each speaker; state is one group's extent."""
    c = cfg.chunk

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, group = state.get if state.exists else (0.0, 0.0, -1)
        rows = pd.concat(list(batches)).sort_values(["start", "seg_idx"], kind="stable")
        ids = []
        for start, end in zip(rows["start"], rows["end"]):
            if group < 0 or end - first > c.max_s or start - last > c.merge_gap_max_s or last - first >= c.target_mean_s:
                first, group = start, group + 1
            last = end
            ids.append(group)
        state.update((first, last, group))
        yield pd.DataFrame({"call_id": key[0], "speaker": key[1], "seg_idx": rows["seg_idx"].to_numpy("int32"), "group_idx": pd.array(ids, dtype="int32")})

    kind = "call_id string, speaker string, seg_idx int, group_idx int"
    return turns.groupBy("call_id", "speaker").applyInPandasWithState(step, kind, "first double, last double, group int", "append", GroupStateTimeout.NoTimeout)


def append_manifest(records: DataFrame, path: str, checkpoint: str):
    """A query that appends every micro-batch of records to a manifest, each batch under its own number."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/batch={number}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
