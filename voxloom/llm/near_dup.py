"""MinHash near-deduplication with fast similarity sketches, banding and exact verification.

1. Every document becomes the set of its distinct 5-word shingles and a sketch of 192 coordinates
   in bands, whose breadth follows from the threshold (``band_rows``).  Documents with equal sets are
   one node from here on.
2. Nodes that share a band's key share a bucket.  Two nodes at the threshold share none with
   probability below 3e-7: (1 - 0.85^6)^32 at 0.85, (1 - 0.8^5)^38 at 0.8.
3. In each bucket every node is verified against the least one on full sets; the links' components
   follow.
4. Buckets that still hold several components are compared wholly, pair by pair inside tasks of at
   most two blocks of ``BLOCK`` nodes, skipping pairs that are in one component already, that meet in
   an earlier band's bucket, or whose sketches agree in fewer coordinates than six standard deviations
   below the threshold.  A first pass over the sketches alone leaves the nodes of a block pair that
   have a pair to verify; full sets travel for these only.  Nodes and links leave a task, never pairs.

So no bucket is capped, no pair of a bucket stays undecided, and rows grow with nodes and
links, not with pairs.

Defined cases: a null text, or one without words, has no shingles and is alone; fewer than five
words are one shingle; repeated rows count as documents of their own with one id; a null id takes
part but never names a component that has other ids; texts are read whole, however long, their words in
slices; an empty table gives no rows; other columns are not read (the filter passes them through).  The filter decides by row instead of by id:
of rows repeated under one id or without one it keeps one, and a row never goes for its namesake.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bits_of
from .common import discard, materialize, small_parts
from .components import components
from .sketches import SIZE, WordHashes, band_keys, digest, shingles, sketch

#: A link has 100 * intersection >= threshold * union; this one is op6's.
THRESHOLD = 85
#: Chance at most that two sets at the threshold share no band.
MISS = 3e-7
#: Nodes of one side of a comparison inside a task.
BLOCK = 256
#: Members of a bucket whose sets meet the hub's in one stream; a larger bucket has several.
STREAM = 256
#: Rows whose sets a task remembers to have given.
MET = 200_000


def least_agreement(threshold: int = THRESHOLD) -> int:
    """Coordinates that sketches of linked sets share but for a chance of 1e-9."""
    j = threshold / 100
    return int(SIZE * (j - 6 * (j * (1 - j) / SIZE) ** 0.5))


def band_rows(threshold: int = THRESHOLD) -> int:
    """The most coordinates a band for which ``MISS`` holds."""
    return max(r for r in range(1, SIZE + 1) if r == 1 or (1 - (threshold / 100) ** r) ** (SIZE // r) < MISS)


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    low, high = sorted((len(a), len(b)))
    if 100 * low < threshold * high:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def sketch_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, bands, marks) of every document."""
    slim = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    rows = band_rows(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for b in small_parts(batches):
            n, nodes, bands, marks = [], [], [], []
            for t in b.column("text").to_pylist():
                items = shingles(t, memo)
                n.append(len(items))
                if len(items):
                    s = sketch(items)
                    nodes.append(digest(items))
                    bands.append(band_keys(s, rows))
                    marks.append(s.astype(np.uint8).tobytes())
                else:
                    nodes.append(None), bands.append(None), marks.append(None)
            columns = [b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node", "bands", "marks"])

    return slim.mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, node binary, bands array<long>, marks binary")


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, items) for the wanted (node, row): the full sets, from the text of one document each.

    Documents are met where they are read, by a set of bits of the wanted (id, hash of the text): no text
    is shuffled, and few sets but the wanted ones.  Rows of one id and one text give their set once a task.
    """
    codes = materialize(wanted.select(F.xxhash64("row.doc_id", "row.text_hash").alias("code")), "wanted")
    shipped = docs.sparkSession.sparkContext.broadcast(bits_of(codes, "code"))
    discard(codes)
    texts = docs.select(F.xxhash64(F.col(key), F.xxhash64(F.col(text))).alias("code"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, met = WordHashes(), set()
        for b in small_parts(batches):
            code = b.column("code").to_numpy()
            nodes, items = [], []
            for i in np.flatnonzero(shipped.value.has(code.view(np.uint64))).tolist():
                if code[i] in met:
                    continue
                if len(met) >= MET:
                    met.clear()
                met.add(code[i])
                found = shingles(b.column("text")[i].as_py(), memo)
                if len(found):
                    nodes.append(digest(found))
                    items.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(items, pa.binary())], ["node", "items"])

    found = texts.mapInArrow(run, "node binary, items binary")
    return found.groupBy("node").agg(F.first("items").alias("items"))


def _verified(stars: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a: hub, b: member) that are linked, on full sets.

    A hub's set travels once for each stream of ``STREAM`` members and is met there by theirs, one after another.
    """
    streams = F.ceil(F.col("n") / STREAM).cast("int")
    hubs = stars.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    heads = hubs.select("a", F.explode(F.sequence(F.lit(0), streams - 1)).alias("stream"), F.col("a").alias("node"))
    members = stars.join(hubs, "a").select("a", F.pmod(F.xxhash64("b"), streams).cast("int").alias("stream"), F.col("b").alias("node"))
    rows = heads.withColumn("member", F.lit(False)).unionByName(members.withColumn("member", F.lit(True))).join(sets, "node")
    rows = rows.select("a", "stream", "member", "node", "items").repartition("a", "stream").sortWithinPartitions("a", "stream", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            member, items, keep = batch.column("member").to_pylist(), batch.column("items"), []
            for i in range(batch.num_rows):
                own = np.frombuffer(items[i].as_py(), np.uint64)
                if not member[i]:
                    hub = own
                keep.append(member[i] and linked(hub, own, threshold))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("node")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "a binary, b binary")


class _Block:
    """The nodes of one bucket's block pair, with their components."""

    def __init__(self, pdf: pd.DataFrame, threshold: int):
        self.pdf = pdf = pdf.sort_values(["block", "node"], kind="stable").reset_index(drop=True)
        self.threshold, self.least = threshold, least_agreement(threshold)
        first: dict = {}
        self.root = np.array([first.setdefault(r, i) for i, r in enumerate(pdf["root"])])
        self.marks = np.frombuffer(b"".join(pdf["marks"]), np.uint8).reshape(len(pdf), SIZE)
        self.bands = np.stack(pdf["bands"].to_numpy()).astype(np.int64)
        self.size = pdf["n_items"].to_numpy()
        self.block, self.bucket = pdf["block"].to_numpy(), pdf["bucket"].iloc[0]
        self.two = pdf["i"].iloc[0] != pdf["j"].iloc[0]

    def open(self, x: int) -> np.ndarray:
        """The later nodes that node x has to be verified against."""
        y = np.arange(x + 1, len(self.pdf))
        if self.two:  # pairs inside a block have a task of their own
            y = y[self.block[y] != self.block[x]]
        y = y[100 * np.minimum(self.size[y], self.size[x]) >= self.threshold * np.maximum(self.size[y], self.size[x])]
        y = y[self.root[y] != self.root[x]]
        if len(y):
            y = y[(self.marks[y] == self.marks[x]).sum(axis=1) >= self.least]
        if len(y):
            same = self.bands[y] == self.bands[x]
            y = y[self.bands[y, same.argmax(axis=1)] == self.bucket]
        return y

    def promising(self) -> np.ndarray:
        """Which nodes have a pair to verify."""
        out = np.zeros(len(self.pdf), bool)
        for x in range(len(self.pdf) - 1):
            y = self.open(x)
            out[y] = True
            out[x] |= bool(len(y))
        return out

    def links(self) -> list[tuple[bytes, bytes]]:
        """Links between the components, as few as join what they join."""
        items = [np.frombuffer(x, np.uint64) for x in self.pdf["items"]]
        found = []
        for x in range(len(items) - 1):
            for v in self.open(x).tolist():
                if self.root[v] != self.root[x] and linked(items[x], items[v], self.threshold):
                    self.root[self.root == self.root[v]] = self.root[x]
                    found.append((self.pdf["node"].iloc[x], self.pdf["node"].iloc[v]))
        return found


_GROUP = ["bucket", "i", "j"]


def _block_links(shared: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links that the stars left open: from larger buckets with nodes of several components."""
    open_ = shared.where("n > 2").select("bucket", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = open_.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("bucket")
    n_blocks = F.ceil(F.col("n") / BLOCK)
    members = open_.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
    others = F.sequence(F.lit(0), (n_blocks - 1).cast("int"))
    members = members.join(nodes.select("node", "bands", "marks", "n_items"), "node")
    members = members.withColumn("other", F.explode(others)).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "n")
    columns = [*_GROUP, "block", "node", "root", "bands", "marks", "n_items"]
    members = members.select(*columns)

    def promising(pdf: pd.DataFrame) -> pd.DataFrame:
        b = _Block(pdf, threshold)
        return b.pdf[b.promising()]

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_Block(pdf, threshold).links(), columns=["a", "b"])

    # little data for much comparing: as many tasks as the session has for a shuffle, however small they are
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = materialize(members.repartition(tasks, *_GROUP).groupBy(*_GROUP).applyInPandas(promising, members.schema), "promising")
    more = materialize(left.join(sets, "node").repartition(tasks, *_GROUP).groupBy(*_GROUP).applyInPandas(links, "a binary, b binary"), "links")
    discard(left)
    return more


def group_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """n_shingles, component_id and kept for every document."""
    sketched = materialize(sketch_documents(docs, key, text, threshold), "sketches")
    row = F.struct("doc_id", "text_hash")
    nodes = sketched.where("node is not null").groupBy("node")
    nodes = nodes.agg(F.min("doc_id").alias("id"), F.min(row).alias("row"), F.first("bands").alias("bands"), F.first("marks").alias("marks"), F.first("n_shingles").alias("n_items"))
    nodes = materialize(nodes, "nodes")

    # buckets of two nodes or more, with their least node and size
    inside = nodes.select("node", F.explode("bands").alias("bucket"))
    hubs = inside.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(inside.join(hubs, "bucket"), "buckets")
    stars = shared.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    sets = materialize(_sets(docs, shared.select("node").distinct().join(nodes.select("node", "row"), "node"), key, text), "sets")
    links = materialize(_verified(stars, sets, threshold), "links")
    roots = components(links)
    more = _block_links(shared, roots, nodes, sets, threshold)
    discard(sets), discard(shared)
    roots = components(links.unionByName(more))

    named = nodes.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    by_node = named.join(least, "root").select("node", "component_id")
    out = sketched.select("doc_id", "n_shingles", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row of each group, with all its columns: the first by (id, row), null ids last.

    Rows are told apart by a number of their own, written with them once so that it stays, as ids may
    be null or repeated.
    """
    row, rank = "near_dup_row", "near_dup_rank"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    ranked = numbered.withColumn(rank, F.struct(F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.col(row).alias("row")))
    gone = group_documents(ranked, rank, text, threshold).where(~F.col("kept")).select(F.col("doc_id.row").alias(row))
    return numbered.join(gone, row, "left_anti").select(*docs.columns)
