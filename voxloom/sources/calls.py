"""Call documents: listing, pairing with recordings, and reading transcripts of varying shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """Paths below a folder; only the listing is read, not the contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root)
    return files.select("path")


def pair_files(paths: DataFrame) -> DataFrame:
    """(json_path, wav_path, skip_reason) for every JSON path.

    The recording of the same stem wins, else the only one of the folder; several are ambiguous.
    """
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    stem = F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1)
    rows = paths.select("path", folder.alias("folder"), stem.alias("stem"), F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).alias("kind"))
    docs = rows.where("kind = 'json'").select(F.col("path").alias("json_path"), "folder", "stem")
    wavs = rows.where("kind = 'wav'").select(F.col("path").alias("wav"), "folder", "stem")
    alone = wavs.groupBy("folder").agg(F.count(F.lit(1)).alias("n"), F.min("wav").alias("only"))
    out = docs.join(wavs, ["folder", "stem"], "left").join(alone, "folder", "left")
    return out.select(
        "json_path",
        F.coalesce("wav", F.when(F.col("n") == 1, F.col("only"))).alias("wav_path"),
        F.when(F.col("wav").isNotNull() | (F.col("n") == 1), F.lit(None)).when(F.col("n") > 1, "ambiguous").otherwise("no wav").alias("skip_reason"),
    )


def path_order(path: str) -> Column:
    """What paths are ordered by: their parts one after another, so that folder ``a`` comes before ``a-b``."""
    return F.split(path, "/")


def first_calls(pairs: DataFrame, n: int) -> DataFrame:
    """The first n pairs by path; 0 means all."""
    return pairs.orderBy(path_order("json_path")).limit(n) if n else pairs


def read_json_documents(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, call) with one document a file as a variant; null where it doesn't parse."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("call"))


def _get(c: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(c, path, kind)


def truthy(c: Column, path: str) -> Column:
    """Python's truth of what stands at a path of a variant; absent is false."""
    kind = F.schema_of_variant(_get(c, path, "variant"))
    return F.coalesce(
        F.when(kind == "BOOLEAN", _get(c, path, "boolean"))
        .when(kind == "STRING", F.length(_get(c, path, "string")) > 0)
        .when(kind.startswith("ARRAY"), F.size(_get(c, path, "array<variant>")) > 0)
        .when(kind.startswith("OBJECT"), F.size(_get(c, path, "map<string,variant>")) > 0)
        .when(kind == "VOID", F.lit(False))
        .otherwise(_get(c, path, "double") != 0),
        F.lit(False),
    )


_TRANSCRIPTS = ("$.analysis.transcript", "$.raw_response.transcript", "$.transcript")


def transcript(call: Column) -> Column:
    """Turns as variants from the first place that holds anything; where that is no list, one turn that can't be read."""
    unreadable = F.array(F.parse_json(F.lit("null")))
    places = [F.when(truthy(call, p), F.coalesce(_get(call, p, "array<variant>"), unreadable)) for p in _TRANSCRIPTS]
    return F.coalesce(*places, F.array().cast("array<variant>"))


def call_id(call: Column, fallback: Column) -> Column:
    named = [F.nullif(_get(call, p, "string"), F.lit("")) for p in ("$.audio_file.ccplatform_url", "$.audio_file.id", "$.request_id")]
    return F.coalesce(*named, fallback)


def audio_quality(call: Column) -> Column:
    return _get(call, "$.raw_response.audio_quality", "string")


def _number(turn: Column, path: str) -> Column:
    """A number, or a string that holds one."""
    return F.coalesce(_get(turn, path, "double"), F.trim(_get(turn, path, "string")).try_cast("double"))


def segments(docs: DataFrame, also: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """Turns as rows from (call_id, call) and the columns of ``also``; ``outer`` keeps calls without turns.

    ``bad_call`` marks all turns of a call with one that has no usable times; it is read from the array
    before turns become rows, so nothing is grouped or joined back.
    """
    places = docs.select("call_id", *also, transcript(F.col("call")).alias("turns"))
    bad = F.exists("turns", lambda t: _number(t, "$.start").isNull() | _number(t, "$.end").isNull())
    explode = F.posexplode_outer if outer else F.posexplode
    rows = places.select("call_id", *also, bad.alias("bad"), explode("turns").alias("seg_idx", "turn"))
    t = F.col("turn")
    text = lambda p: strip(F.coalesce(_get(t, p, "string"), F.lit("")))
    there = lambda c: F.when(F.col("seg_idx").isNotNull(), c)
    return rows.select(
        "call_id",
        *also,
        "seg_idx",
        _number(t, "$.start").alias("start"),
        _number(t, "$.end").alias("end"),
        there(text("$.text")).alias("text"),
        there(text("$.speaker")).alias("speaker"),
        there(truthy(t, "$.overlap")).alias("overlap"),
        _get(t, "$.sentiment", "string").alias("sentiment"),
        _get(t, "$.tone_description", "string").alias("tone_description"),
        _get(t, "$.confidence", "double").alias("src_confidence"),
        there(F.col("bad")).alias("bad_call"),
    )
