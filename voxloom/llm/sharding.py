"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows are shuffled by a seeded digest within each source, the rank becomes a fraction of the
source's size, and the rows in order of that fraction are cut into shards of equal counts.
Every shard then holds every source in proportion, to within one row a source and cut.

No window spans a source: ranks come from a running count within a (source, digest bucket) cell
plus one of the cells before it, and positions likewise from buckets of the
fraction.  The number of buckets follows the number of rows, so that a source with a third of
all rows is spread over many tasks.  The digest is of key and text, so rows of one key spread too, and rows alike
in key, text and source are counted before they move: however many, they are one row until their ranks are dealt.

Defined cases: a null source is a stratum of its own; a null text has size 1 and the checksum
of no bytes (0); a null key is shuffled as the empty string; rows alike in key, text and
source are interchangeable; texts are only measured and summed, whole and however long; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = "voxloom-1"
#: Rows alike that are dealt from one row at once.
DEALT = 1 << 16


def _utf8(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def _buckets(n_rows: int, rows_per_bucket: int, least: int) -> int:
    return max(least, -(-n_rows // rows_per_bucket))


def _running(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows before each bucket, from one row a bucket."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))


def interleave_shards(
    docs: DataFrame,
    n_shards: int = 16,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
    rows_per_bucket: int = 100_000,
    least_buckets: int = 256,
) -> DataFrame:
    """Shard and slot of every row; ``law`` is ``rows``: shard sizes differ by one row at most."""
    total = docs.count()
    n_buckets = _buckets(total, rows_per_bucket, least_buckets)
    base = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(_utf8(F.col(text))).alias("text_crc32"),
    )
    named = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32", "size")
    base = base.withColumn("digest", F.md5(named)).withColumn("cell", F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * n_buckets, 32))
    alike = base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("copies"))

    cells = alike.groupBy("stratum", "cell").agg(F.sum("copies").alias("n"))
    cells = _running(cells, ["stratum"], "cell").withColumn("in_stratum", F.sum("n").over(Window.partitionBy("stratum"))).drop("n")
    within = Window.partitionBy("stratum", "cell").orderBy("digest", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = alike.join(cells, ["stratum", "cell"]).withColumn("before", F.col("before") + F.coalesce(F.sum("copies").over(within), F.lit(0)))
    ranked = ranked.withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), "copies", F.lit(DEALT).cast("long"))))
    ranked = ranked.withColumn("nth", F.explode(F.sequence("from", F.least(F.col("from") + (DEALT - 1), "copies"))))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth")).drop("from", "nth", "copies")
    ranked = ranked.withColumn("fraction", (2 * F.col("rank") - 1).cast("double") / (2 * F.col("in_stratum")).cast("double"))
    ranked = ranked.withColumn("band", F.floor(F.col("fraction") * n_buckets)).drop("before", "cell", "in_stratum")

    bands = _running(ranked.groupBy("band").agg(F.count(F.lit(1)).alias("n")), [], "band").drop("n")
    along = Window.partitionBy("band").orderBy("fraction", "stratum")
    placed = ranked.join(bands, "band").withColumn("pos", F.col("before") + F.row_number().over(along) - 1)
    shard = F.expr(f"(pos * {n_shards}L) div {max(total, 1)}L")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        # the first position of shard s is the least p with p * n_shards >= s * total
        F.expr(f"pos - ((shard * {total}L + {n_shards - 1}L) div {n_shards}L)").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
