"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n."""
    return F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, allowed: Column | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, label) of one document each of at most ``most`` labelled keys, drawn by a hash of the key.

    The drawn keys number at most ``most``, which bounds what is broadcast and, as one row a key is
    taken (the one whose text has the least hash), the sample; only their texts move.  Rows without a
    key or a label are never drawn; of contradicting labels the highest counts.
    """
    drawn = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    if allowed is not None:
        drawn = drawn.where(allowed)
    drawn = drawn.groupBy(F.col(key).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(drawn), "doc_id")
    return materialize(rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "sample")


def within(sample: DataFrame, size: Column, most: int, share: int = 100) -> DataFrame:
    """Rows of a sample, of both classes (label 0 and others), whose sizes add up to ``most`` at most.

    Each class has half of ``most``, and what the other leaves.  Rows go in order of a hash of the key.  Those larger than
    ``most / share`` are left out, so that a few huge rows neither fill the sample nor outweigh it; where a class has no others, its
    smallest is taken.  A class's first row may have up to ``most`` alone; it is an error if it has more.  The sample is bounded already, so its keys and sizes may pass one task.
    """
    positive = (F.col("label") > 0).alias("positive")
    sized = sample.select("doc_id", positive, size.cast("long").alias("size"))
    huge = F.col("size") * share > most
    order = Window.partitionBy("positive").orderBy(huge, F.when(huge, F.col("size")).otherwise(0), F.xxhash64("doc_id"), "doc_id")
    sized = sized.withColumn("nth", F.row_number().over(order)).where(~huge | (F.col("nth") == 1))
    sized = sized.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    of_class = F.sum("size").over(Window.partitionBy("positive"))
    sized = sized.withColumn("rest", F.sum("size").over(Window.partitionBy()) - of_class)
    room = F.greatest(F.lit(most // 2), most - F.col("rest"))
    kept = sized.where((F.col("upto") <= room) | (F.col("nth") == 1) & (F.col("size") <= most))
    kept = materialize(kept.select("doc_id", "positive"), "within")
    if kept.select("positive").distinct().count() < sample.select(positive).distinct().count():
        raise ValueError(f"no document of one class fits into a sample of {most} lines or features; raise the bound")
    return sample.join(F.broadcast(kept.select("doc_id")), "doc_id")
