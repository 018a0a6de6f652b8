"""Queries of the text operators, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, collocations, decontamination, divergence, language_model, licenses, near_dup, quality, repeats, sharding, syncmers, token_counts, toxicity
from .common import documents, table
from .labelled import remainder


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave_shards(documents(spark, sf_dir))


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), _vocabulary())


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edits(documents(spark, sf_dir))


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.group_documents(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), allowed=remainder("doc_id", 3) != 1)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return quality.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(documents(spark, sf_dir))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_documents(documents(spark, sf_dir), _vocabulary())


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(documents(spark, sf_dir), remainder("doc_id", 7) == 2)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).drop("kept_text")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_decontamination": op2_decontamination,
        "op3_token_counts": op3_token_counts,
        "op4_toxicity": op4_toxicity,
        "op5_syncmers": op5_syncmers,
        "op6_near_dup": op6_near_dup,
        "op7_quality": op7_quality,
        "op8_licenses": op8_licenses,
        "op9_bpe_codec": op9_bpe_codec,
        "op10_language_model": op10_language_model,
        "op11_collocations": op11_collocations,
        "op12_substring_dedup": op12_substring_dedup,
        "op13_divergence": op13_divergence,
    }


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return {
        "op1_sharding": oracles.SHARDING,
        "op6_near_dup": oracles.NEAR_DUP,
        "op11_collocations": oracles.COLLOCATIONS,
        "op12_substring_dedup": oracles.REPEATS,
        "op13_divergence": oracles.DIVERGENCE,
    }
