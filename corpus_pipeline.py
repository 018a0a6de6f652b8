"""From raw documents to token ids: filter, deduplicate, decontaminate, encode.

Each stage is called with the documents that its predecessor kept, written as Parquet and read again.
All but the last return the columns of ``documents``.

Defined cases, at every stage: a null or empty text is a document of its own (one empty line of the
quality classifier, no toxic word, no shingle, no passage, no token) and is kept where the classifier keeps it; a null id
never matches a label and its row is judged by its text; repeated rows are judged alike, and the near-duplicate stage
keeps one of them, except of those without words, which are alone; an empty table stays empty, and
without labels of both kinds a classifier judges all documents by the share of its sample; a text of any length is read
whole; further columns pass through to the last stage, whatever their names.

Intermediate results lie below ``spark.checkpoint.dir``; ``voxloom.scratch.clear`` deletes them once
the result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import bpe_codec, decontamination, near_dup, quality, toxicity
from voxloom.llm.common import discard, documents, materialize, table
from voxloom.llm.labelled import remainder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-chain classifier takes for good ones."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), allowed=remainder("doc_id", 3) != 1)
    return quality.drop_bad(docs, model)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose likeliest severity grade is 0."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, from a similarity of word shingles of 0.8 on."""
    return near_dup.drop_near_duplicates(docs, threshold=80)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the round trip as digests."""
    import public_tokenizers

    return bpe_codec.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True, with_text=False)


STAGES = [
    ("quality", keep_quality),
    ("toxicity", keep_civil),
    ("near_dup", keep_distinct),
    ("decontamination", keep_uncontaminated),
    ("bpe", encode),
]

#: The fitted and the sketching stages are beyond SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(before)  # the tables themselves were never written here and stay
    return STAGES[-1][1](spark, docs, sf_dir)
