"""Global ranks without a task or a driver that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize


def global_rank(df: DataFrame, keys: list[Column], name: str = "rank") -> DataFrame:
    """Rows with their 0-based place in the order of ``keys`` (which should tell rows apart).

    Rows are dealt by ranges of the keys and written once with the number of their range; a rank is
    then the rows of earlier ranges, from one count a range, plus the place within the range.
    """
    rows = materialize(df.repartitionByRange(*keys).withColumn("range_no", F.spark_partition_id()), "ranges")
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("range_no").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("range_no").orderBy(*keys)) - 1
    return rows.join(counts, "range_no").withColumn(name, F.col("before") + place).drop("range_no", "before")
