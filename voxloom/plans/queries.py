"""Registered queries of the speech-corpus operators, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import gates, scoring, text
from ..operators import manifest, reports, signal, turns
from ..scratch import materialize
from ..settings import Settings
from ..sources import calls, manifests, writers
from . import views
from .views import EVENTS, HOUR, SCRIPT, STRICT, TALK, table

CFG = Settings()
KEYS = ["call_id", "speaker"]
FRAME, LOUD = 8, 100_000_000

_found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _found[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_found)


def _ids(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda i: i.cast("string")), ",")


@query
def q01_segments_from_turns(spark, sf_dir):
    return turns.usable(views.talk_segments(spark, sf_dir)).withColumn("duration", F.greatest(F.lit(0.0), F.col("end") - F.col("start")))


@query
def q02_turns_by_speaker(spark, sf_dir):
    rows = turns.turns_by_speaker(views.talk_segments(spark, sf_dir))
    return rows.select(*KEYS, F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["seg_idx"].cast("string")), ",").alias("seg_ids"))


@query
def q03_group_turns(spark, sf_dir):
    return turns.assign_groups(views.talk_segments(spark, sf_dir), TALK).select(*KEYS, "group_idx", "seg_idx")


@query
def q04_group_events(spark, sf_dir):
    return turns.assign_groups(views.event_segments(spark, sf_dir), EVENTS).select(*KEYS, "group_idx", "seg_idx")


@query
def q04_group_events_scan(spark, sf_dir):
    return turns.assign_groups_streaming(views.event_segments(spark, sf_dir), EVENTS).select(*KEYS, "group_idx", "seg_idx")


@query
def q05_gap_groups(spark, sf_dir):
    return turns.gap_groups(views.event_segments(spark, sf_dir), 6 * HOUR).select(*KEYS, "group_idx", "seg_idx")


@query
def q06_silence_clusters(spark, sf_dir):
    return turns.silence_clusters(views.event_regions(spark, sf_dir), KEYS, 5 * HOUR)


@query
def q07_regions_clipped(spark, sf_dir):
    regions = views.event_regions(spark, sf_dir).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("regions"))
    windows = views.event_segments(spark, sf_dir).groupBy(*KEYS).agg(F.min("start").alias("g0"))
    rows = windows.withColumn("g1", F.col("g0") + 240 * HOUR).join(regions, KEYS)
    return rows.select(*KEYS, F.inline(turns.clip_regions(F.col("regions"), F.col("g0"), F.col("g1"))))


@query
def q08_best_cluster(spark, sf_dir):
    rows = views.event_segments(spark, sf_dir).select(*KEYS, "seg_idx", (F.col("start") - 3 * HOUR).alias("start"), (F.col("end") + 9 * HOUR).alias("end"))
    clusters = turns.silence_clusters(views.event_regions(spark, sf_dir), KEYS, 5 * HOUR)
    return turns.best_cluster(rows, clusters, KEYS, ["seg_idx"]).select(*KEYS, "seg_idx", "c_idx", "shared")


@query
def q09_split_group(spark, sf_dir):
    groups = turns.collect_groups(turns.assign_groups(views.event_segments(spark, sf_dir), EVENTS))
    ordered = F.array_sort(F.collect_list(F.struct("r_idx", "s", "e")))
    regions = views.event_regions(spark, sf_dir).groupBy(*KEYS).agg(F.transform(ordered, lambda r: F.struct(r["s"].alias("s"), r["e"].alias("e"))).alias("regions"))
    out = turns.split_groups(groups, regions, EVENTS, KEYS)
    return out.select(*KEYS, "group_idx", "piece_idx", "start", "end", _ids("segment_indices").alias("seg_ids"), "has_overlap")


def _spoken(spark, sf_dir):
    words = F.filter(F.split("text", r"[ \t\n\r]+"), lambda w: w != "")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("call_id"), F.lit("reader").alias("speaker"), views.read_aloud(words).alias("words"))


PACK = Settings(chunk=views.Chunking(max_s=28_000.0, target_mean_s=12_000.0, pause_cut_s=400.0))


@query
def q10_chunk_words(spark, sf_dir):
    return turns.chunk_words(_spoken(spark, sf_dir), PACK).select(*KEYS, "chunk_idx", "start", "end", "n_words", F.md5("text").alias("text_md5"), F.round("confidence", 6).alias("confidence"))


def _talk_chunks(spark, sf_dir):
    return turns.whole_chunks(turns.collect_groups(turns.assign_groups(views.talk_segments(spark, sf_dir), TALK)))


@query
def q11_overlap_fraction(spark, sf_dir):
    return _talk_chunks(spark, sf_dir).select(*KEYS, "group_idx", "has_overlap", F.round("overlap_fraction", 6).alias("overlap_fraction"), F.md5("text").alias("text_md5"))


@query
def q12_cps(spark, sf_dir):
    d = gates.effective_duration()
    return views.measured(spark, sf_dir).select("doc_id", d.alias("duration"), F.round(gates.chars_per_second(F.col("text"), d), 6).alias("cps"))


def _frames(spark, sf_dir):
    return signal.frame_energy(views.signals(spark, sf_dir), "samples", FRAME, ["vec_id"])


def _regions(spark, sf_dir):
    return signal.speech_regions(_frames(spark, sf_dir), ["vec_id"], LOUD)


def _totals(spark, sf_dir):
    return views.signals(spark, sf_dir).select("vec_id", F.floor(F.size("samples") / F.lit(FRAME)).alias("total"))


@query
def q13_frames_vad(spark, sf_dir):
    return _regions(spark, sf_dir).select("vec_id", "r_idx", "s", "e")


@query
def q14_silence_ratio(spark, sf_dir):
    return signal.silence_ratio(_regions(spark, sf_dir), _totals(spark, sf_dir), ["vec_id"])


@query
def q15_silence_gaps(spark, sf_dir):
    return signal.silence_gaps(_regions(spark, sf_dir), _totals(spark, sf_dir), ["vec_id"], 2)


@query
def q16_rms_db(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(signal.level_db(F.col("embedding")), 6).alias("level_db"))


@query
def q17_channel_corr(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 2").alias("pair"), (F.col("vec_id") % 2).alias("side"), "embedding")
    both = v.groupBy("pair").agg(F.max(F.when(F.col("side") == 0, F.col("embedding"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("embedding"))).alias("b")).where("a is not null and b is not null")
    return signal.correlation(both, "a", "b", ["pair"]).withColumn("correlation", F.round("correlation", 6))


@query
def q18_energy_share(spark, sf_dir):
    e = _frames(spark, sf_dir).groupBy("vec_id").agg(F.sum("energy").alias("energy")).join(views.signals(spark, sf_dir).select("vec_id", "label"), "vec_id")
    e = e.groupBy("label", (F.col("vec_id") % 4).alias("channel")).agg(F.sum("energy").alias("energy"))
    return signal.energy_share(e, ["label"]).withColumn("share", F.round("share", 9))


def _energies(spark, sf_dir):
    e = _frames(spark, sf_dir).groupBy("vec_id").agg(F.sum("energy").alias("energy"))
    return e.select(
        F.expr("vec_id div 4").cast("string").alias("call_id"),
        F.when(F.col("vec_id") % 4 < 2, "agent").otherwise("caller").alias("speaker"),
        (F.col("vec_id") % 2).cast("int").alias("channel"),
        "energy",
    )


@query
def q19_channel_assign(spark, sf_dir):
    return signal.assign_channels(_energies(spark, sf_dir))


@query
def q19_turns_with_channel(spark, sf_dir):
    mapping = signal.assign_channels(_energies(spark, sf_dir)).withColumn("speaker", F.when(F.col("speaker") == "agent", "assistant").otherwise("user"))
    return signal.with_channel(views.talk_segments(spark, sf_dir).select(*KEYS, "seg_idx"), mapping)


@query
def q20_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_persian(F.col("text")).alias("normalized"))


@query
def q21_script_ratio(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.round(text.script_ratio(F.col("text"), "00C0", "024F"), 9).alias("ratio"))


def _judged(spark, sf_dir):
    reason = gates.reject_reason(STRICT, gates.effective_duration(), F.col("audio_quality"), SCRIPT)
    return views.measured(spark, sf_dir).withColumn("reject_reason", reason)


@query
def q22_reject_reason(spark, sf_dir):
    return _judged(spark, sf_dir).select("doc_id", "reject_reason")


@query
def q23_reject_counts(spark, sf_dir):
    return reports.counts(_judged(spark, sf_dir).where("reject_reason is not null"), F.col("reject_reason"), "reject_reason")


def _scored(spark, sf_dir):
    c = scoring.confidence(CFG, F.col("alignment_score"), F.col("agreement_score"), F.col("overlap_fraction"), F.col("chars_per_sec"))
    rows = views.measured(spark, sf_dir).withColumn("confidence", c)
    return rows.withColumns({"tier": scoring.tier(CFG, F.col("confidence")), "loss_weight": scoring.loss_weight(CFG, F.col("confidence"))})


@query
def q24_confidence(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", F.round("confidence", 9).alias("confidence"))


@query
def q25_tiers(spark, sf_dir):
    return _scored(spark, sf_dir).groupBy("tier", "loss_weight").agg(F.count(F.lit(1)).alias("n"))


def _capped(spark, sf_dir):
    return manifest.cap_overlap(_scored(spark, sf_dir), CFG, ["doc_id"])


@query
def q26_overlap_cap(spark, sf_dir):
    return _capped(spark, sf_dir).select("doc_id", "has_overlap")


@query
def q27_split_hash(spark, sf_dir):
    rows = views.talk_segments(spark, sf_dir)
    return manifest.split_by_call(rows, manifest.test_calls_by_hash(rows, CFG)).select("call_id", "seg_idx", "split")


@query
def q28_split_seeded(spark, sf_dir):
    rows = views.talk_segments(spark, sf_dir)
    return manifest.split_by_call(rows, manifest.test_calls_by_shuffle(rows, CFG)).select("call_id", "seg_idx", "split")


@query
def q29_merge_gold(spark, sf_dir):
    train = _scored(spark, sf_dir).select(F.col("doc_id").alias("id"), "text", "tier", "loss_weight")
    gold = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text", F.when(F.col("item_id") % 3 == 0, F.lit("2")).alias("loss_weight"))
    return manifest.merge_gold(train, gold, CFG).select("id", F.md5("text").alias("text_md5"), "tier", "loss_weight", "source")


@query
def q30_manifest_record(spark, sf_dir):
    rows = manifest.to_records(views.measured(spark, sf_dir).withColumn("start", F.lit(0.25)))
    return rows.select("doc_id", "duration", F.element_at("extent", 1).alias("extent_start"), F.element_at("extent", 2).alias("extent_end"))


@query
def q31_length_buckets(spark, sf_dir):
    return reports.counts(views.measured(spark, sf_dir), gates.length_bucket(CFG, gates.effective_duration()), "bucket")


@query
def q32_duration_bands(spark, sf_dir):
    counted = reports.counts(views.measured(spark, sf_dir), gates.duration_band(F.col("clip_duration")), "band")
    return reports.shares(counted).withColumn("percent", F.round("percent", 6))


@query
def q33_conf_histogram(spark, sf_dir):
    return reports.confidence_histogram(_scored(spark, sf_dir)).orderBy("bucket")


@query
def q34_manifest_totals(spark, sf_dir):
    t = reports.totals(manifest.to_records(views.measured(spark, sf_dir)))
    return t.select("n_records", F.round("hours", 6).alias("hours"), F.round("mean_duration", 6).alias("mean_duration"))


@query
def q34_source_counts(spark, sf_dir):
    return reports.counts(q29_merge_gold(spark, sf_dir), F.concat_ws("/", F.coalesce("tier", F.lit("?")), F.coalesce("source", F.lit("silver"))), "tier_source")


@query
def q35_turn_stats(spark, sf_dir):
    s = reports.turn_stats(views.talk_segments(spark, sf_dir), 5.0)
    return s.select(*KEYS, "turns", *(F.round(c, 6).alias(c) for c in ("speech_s", "min_s", "median_s", "max_s")), "n_short")


def _call_docs(spark, sf_dir):
    """Events as call documents of several shapes, with their properties as the only turn."""
    e = table(spark, sf_dir, "events")
    turn = F.format_string(
        '{"start": %s, "end": %s, "text": " %s\\t", "speaker": "%s", "overlap": %s}',
        F.when(F.col("event_id") % 17 == 0, F.lit("null")).when(F.col("event_id") % 2 == 0, F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('.5"'))).otherwise(F.col("event_id").cast("string")),
        (F.col("event_id") + 7).cast("string"),
        F.col("event_type"),
        F.when(F.col("event_id") % 13 == 0, "").otherwise(F.col("event_type")),
        F.element_at(F.array(*map(F.lit, ("true", "false", '"false"', '""', "0", "2", "null", "[]", "[1]", "{}"))), (F.col("event_id") % 10 + 1).cast("int")),
    )
    shape = F.element_at(
        F.array(
            F.concat(F.lit('{"analysis": {"transcript": ['), turn, F.lit(']}, "audio_file": {"ccplatform_url": "", "id": "A'), F.col("event_id"), F.lit('"}}')),
            F.concat(F.lit('{"analysis": "x", "raw_response": {"audio_quality": "good", "transcript": ['), turn, F.lit("]}, "), F.lit('"props": '), F.coalesce("props", F.lit("null")), F.lit("}")),
            F.concat(F.lit('{"analysis": {"transcript": []}, "request_id": "R'), F.col("event_id"), F.lit('", "audio_file": null, "transcript": ['), turn, F.lit("]}")),
            F.lit("{}"),
        ),
        (F.col("user_id") % 4 + 1).cast("int"),
    )
    docs = e.select(F.concat(F.lit("wav"), F.col("event_id").cast("string")).alias("stem"), F.try_parse_json(shape).alias("call"))
    return docs.select("stem", "call", calls.call_id(F.col("call"), F.col("stem")).alias("call_id"), calls.audio_quality(F.col("call")).alias("audio_quality"))


@query
def q36_json_extract(spark, sf_dir):
    docs = _call_docs(spark, sf_dir)
    s = calls.segments(docs, also=("stem", "audio_quality"), outer=True)
    return s.select("call_id", "stem", "audio_quality", "seg_idx", "start", "end", "text", "speaker", "overlap", "bad_call")


@query
def q37_pair_files(spark, sf_dir):
    """Every document id makes paths; which of them exist is part of the made-up folders, so that all cases of pairing occur."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("i"))
    path = lambda *parts: F.concat(F.lit("/c/"), F.expr("i div 4").cast("string"), *parts)
    js = d.select(path(F.lit("/"), F.when(F.expr("i div 4") % 3 == 0, F.col("i").cast("string")).otherwise("report"), F.lit(".json")).alias("path")).distinct()
    wav = d.where("i % 2 = 0 and (i div 4) % 5 <> 4 and not ((i div 4) % 3 = 1 and i % 4 = 2)").select(path(F.lit("/"), F.col("i").cast("string"), F.lit(".wav")).alias("path"))
    return calls.pair_files(js.unionByName(wav))


def _manifest_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.when(F.col("role") == "system", " Silence ").otherwise(F.col("role")).alias("speaker"),
        F.when((F.col("conv_id") + F.col("turn")) % 9 == 0, " \t").otherwise(F.col("text")).alias("text"),
        F.when(F.col("turn") % 4 == 3, F.lit(None)).otherwise(F.concat(F.lit("clips/"), F.col("conv_id").cast("string"), F.lit(".wav"))).alias("audio_path"),
        F.when(F.col("turn") > 0, F.col("turn") / 8.0).cast("double").alias("confidence"),
    )


def _listing(spark, sf_dir):
    """Which made-up recordings exist below which root, so that every rank of candidates occurs."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("i")).distinct()
    roots = F.explode(F.array(F.lit(""), F.lit("/work/"), F.lit("/data/build/")))
    return c.select("i", roots.alias("root")).where("(root = '' and i % 5 = 0) or (root = '/work/' and i % 3 = 0) or (root = '/data/build/' and i % 2 = 0)").select(F.concat("root", F.lit("clips/"), "i", F.lit(".wav")).alias("path"))


@query
def q38_load_rows(spark, sf_dir):
    rows = manifests.resolve_paths(_manifest_rows(spark, sf_dir), _listing(spark, sf_dir), ["/work", "/data/build"])
    return reports.counts(manifests.load_rows(rows), F.col("outcome"), "outcome")


@query
def q38_training_rows(spark, sf_dir):
    rows = manifests.resolve_paths(_manifest_rows(spark, sf_dir), _listing(spark, sf_dir), ["/work", "/data/build"])
    kept = manifests.load_rows(rows).where("outcome = 'kept'")
    return kept.select("audio", F.md5("text").alias("text_md5"), F.col("confidence").cast("double").alias("confidence"))


@query
def q39_build_stats(spark, sf_dir):
    # texts are judged and scored once; what is counted several times is written without them
    judged = materialize(_judged(spark, sf_dir).select("doc_id", "reject_reason"), "judged")
    scored = materialize(_scored(spark, sf_dir).drop("text"), "scored")
    capped = manifest.cap_overlap(scored, CFG, ["doc_id"]).withColumn("call_id", F.expr("doc_id div 10").cast("string"))
    capped = manifest.split_by_call(capped, manifest.test_calls_by_hash(capped, CFG))
    call_rows = table(spark, sf_dir, "documents").select((F.col("doc_id") % 29 == 0).alias("skipped"))
    s = reports.build_stats(judged, capped, call_rows)
    line = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return s.withColumns({"rejected": line("rejected"), "tiers": line("tiers")})


@query
def q40_agreement(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 6 != 0, F.regexp_replace("text", r"\b[aeh]\w+ ", "")).alias("second"))
    return d.withColumn("a", text.agreement(F.col("text"), F.col("second"))).select("doc_id", F.col("a.score").alias("score"), F.size("a.missed").alias("n_missed"))


@query
def q41_clips_tsv(spark, sf_dir):
    rows = _talk_chunks(spark, sf_dir).select(
        F.when(F.col("group_idx") % 2 == 0, F.concat_ws("_", *KEYS, "group_idx")).alias("audio_path"), F.when(F.col("has_overlap"), "review").alias("tier"), F.when(F.col("overlap_fraction") > 0, 1 - F.col("overlap_fraction") / 2).alias("confidence"), "text"
    )
    return rows.where("audio_path is not null").select(writers.clip_line().alias("value"))


@query
def q42_safe_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.safe_id(F.col("url")).alias("safe_id"), text.preview(F.col("html")).alias("preview"))


@query
def q43_limit_calls(spark, sf_dir):
    folder = F.element_at(F.array(*map(F.lit, views.FOLDERS)), (F.col("page_id") % len(views.FOLDERS) + 1).cast("int"))
    pairs = table(spark, sf_dir, "pages").select(F.concat(folder, F.lit("/"), "url").alias("json_path"), "page_id")
    return calls.first_calls(pairs.groupBy("json_path").agg(F.min("page_id").alias("page_id")), 25)


@query
def q44_ref_text(spark, sf_dir):
    rows = turns.turns_by_speaker(views.talk_segments(spark, sf_dir))
    return rows.select(*KEYS, F.trim(F.array_join(F.transform("turns", lambda t: t["text"]), " ")).alias("ref_text"))


@query
def q45_edge_words(spark, sf_dir):
    w = _spoken(spark, sf_dir).where(F.size("words") > 0)
    kept = turns.trim_edge_words(F.col("words"), 0.65)
    return w.withColumn("kept", kept).select("call_id", F.size("kept").cast("long").alias("n_kept"), F.array_min(F.transform("kept", lambda x: x["word_idx"])).alias("first_idx"), F.array_max(F.transform("kept", lambda x: x["word_idx"])).alias("last_idx"))


@query
def q46_resolve_path(spark, sf_dir):
    rows = _manifest_rows(spark, sf_dir).select("audio_path").where("audio_path is not null").distinct()
    return manifests.resolve_paths(rows, _listing(spark, sf_dir), ["/work", "/data/build"])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations to chunks to gates, confidence and tiers, counted by outcome."""
    chunks = _talk_chunks(spark, sf_dir).withColumns({"clip_duration": F.col("end") - F.col("start"), "silence_ratio": F.lit(None).cast("double")})
    chunks = chunks.withColumn("chars_per_sec", gates.chars_per_second(F.col("text"), F.col("clip_duration")))
    judged = chunks.withColumn("reject_reason", gates.reject_reason(TALK, F.col("clip_duration"), script=SCRIPT))
    align = F.when(F.size("segment_indices") > 1, 0.9).cast("double")
    agree = F.when(F.col("call_id") % 2 == 0, 0.8).cast("double")
    c = scoring.confidence(TALK, align, agree, F.col("overlap_fraction"), F.col("chars_per_sec"))
    scored = judged.withColumn("tier", F.when(F.col("reject_reason").isNull(), scoring.tier(TALK, c)))
    return scored.groupBy("reject_reason", "tier").agg(F.count(F.lit(1)).alias("n_chunks"), F.round(F.sum("clip_duration"), 3).alias("seconds"))


_found["q00_outcomes"] = flagship


@query
def q47_ctc_align(spark, sf_dir):
    """Vectors as emissions of 16 frames and 4 outputs, with a row of three outputs from the label."""
    rows = table(spark, sf_dir, "embeddings")
    digits = F.array(F.col("label") % 3 + 1, F.expr("label div 3") % 3 + 1, F.col("label") % 2 + 1)
    path = signal.ctc_path(F.col("embedding"), digits.cast("array<int>"), 4)
    return rows.withColumn("path", path).select("vec_id", "path.score", _ids("path.first").alias("first"), _ids("path.end").alias("end"))
