"""Counts, bands, histograms and turn statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts(df: DataFrame, by: Column, name: str) -> DataFrame:
    return df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def shares(counted: DataFrame) -> DataFrame:
    """Counts of a few classes with their percentage of all."""
    return counted.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def confidence_histogram(df: DataFrame, c: str = "confidence", width: int = 40) -> DataFrame:
    """Tenths of confidence with a bar scaled to the fullest; at most a few rows."""
    bucket = F.format_string("%.1f", (F.col(c) * 10).cast("int") / F.lit(10.0))
    rows = counts(df.where(F.col(c).isNotNull()), bucket, "bucket")
    top = F.max("n").over(Window.partitionBy())
    return rows.withColumn("bar", F.repeat(F.lit("#"), F.floor(F.col("n") * width / top).cast("int")))


def totals(records: DataFrame) -> DataFrame:
    """Records, hours and mean duration; a record without duration counts with 0."""
    seconds = F.coalesce("duration", F.lit(0.0))
    return records.agg(F.count(F.lit(1)).alias("n_records"), (F.sum(seconds) / 3600).alias("hours"), F.avg(seconds).alias("mean_duration"))


def tier_counts(df: DataFrame) -> DataFrame:
    return counts(df, F.coalesce("tier", F.lit("?")), "tier")


def turn_stats(segments: DataFrame, min_s: float) -> DataFrame:
    """Turns, speech and durations of each speaker of each call; the median is exact."""
    d = F.greatest(F.lit(0.0), F.col("end") - F.col("start"))
    return segments.withColumn("d", d).groupBy("call_id", "speaker").agg(
        F.count(F.lit(1)).alias("turns"), F.sum("d").alias("speech_s"), F.min("d").alias("min_s"), F.median("d").alias("median_s"), F.max("d").alias("max_s"), F.count_if(F.col("d") < min_s).alias("n_short")
    )


def as_map(counted: DataFrame, key: str) -> DataFrame:
    """Counts of a few classes as one row with a map."""
    pair = F.struct(F.col(key), F.col("n"))
    return counted.agg(F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("counts"))


def build_stats(scored: DataFrame, capped: DataFrame, calls: DataFrame) -> DataFrame:
    """One row of corpus counts.  ``scored`` has reject_reason, ``capped`` tier and split, ``calls`` a skipped flag."""
    a = calls.agg(F.count(F.lit(1)).alias("calls"), F.count_if("skipped").alias("calls_skipped"))
    b = scored.agg(F.count_if(F.col("reject_reason").isNull()).alias("chunks_kept"))
    c = capped.agg(
        F.count(F.lit(1)).alias("after_overlap_cap"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
        F.count_if(F.col("tier") == "review").alias("review_queue"),
    )
    rejected = as_map(counts(scored.where("reject_reason is not null"), F.col("reject_reason"), "reason"), "reason").withColumnRenamed("counts", "rejected")
    tiers = as_map(tier_counts(capped), "tier").withColumnRenamed("counts", "tiers")
    one = lambda df: df.withColumn("one", F.lit(1))  # noqa: E731  single rows meet on a constant key
    out = one(a)
    for part in (b, c, rejected, tiers):
        out = out.join(one(part), "one")
    return out.drop("one")
