"""Text, gates, scores and manifest steps against worked examples."""

import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.functions import gates, scoring, text
from voxloom.operators import manifest, reports, signal
from voxloom.operators.ranking import global_rank
from voxloom.settings import Settings, load_settings, overlay

CFG = Settings()


def one(spark, c, **values):
    row = {k: v for k, v in values.items()}
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None and k in ('ref', 'hyp', 't') else 'double'}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], kinds).select(c.alias("v")).first()["v"]


def test_normalise(spark):
    n = text.normalize_persian(F.col("t"))
    assert one(spark, n, t="كتاب علي") == one(spark, n, t="کتاب علی") == "کتاب علی"
    assert one(spark, n, t="  a\tb،c! ١۲ می‌روم ﷼x") == "a b،c 12 می روم ریالx"
    assert one(spark, n, t=None) == ""


@pytest.mark.parametrize("t,want", [("سلام دنیا", 1.0), ("hello world", 0.0), ("۱۰۱ ۳۴", 1.0), ("سلام ۱۲۳", 1.0), ("", 0.0), ("aس", 0.5)])
def test_script_ratio(spark, t, want):
    assert one(spark, text.script_ratio(F.col("t")), t=t) == want


@pytest.mark.parametrize(
    "ref,hyp,score,missed",
    [
        ("سلام دنیا خوب", "سلام دنیا خوب", 1.0, []),
        ("سلام دنیا خوب", "سلام دنیا", 2 / 3, ["خوب"]),
        ("a b", None, None, []),
        ("a b c d", "a x c d", 0.75, ["b"]),
        ("a b", "a b c d e", 1.0, []),
        ("a a", "a", 0.5, ["a"]),
        ("a b c b d", "b d a b c", 0.6, ["b", "d"]),
        ("x y a b c d", "a q b q c q d x y", 2 / 6, ["a", "b", "c", "d"]),
        ("", "a", None, []),
        ("a", "", 0.0, ["a"]),
    ],
)
def test_agreement(spark, ref, hyp, score, missed):
    got = one(spark, text.agreement(F.col("ref"), F.col("hyp")), ref=ref, hyp=hyp)
    assert (got.score is None if score is None else got.score == pytest.approx(score)) and got.missed == missed


BASE = {"text": "سلام دنیا خوب است", "clip_duration": 2.0, "silence_ratio": 0.1, "chars_per_sec": 7.0, "overlap_fraction": 0.0, "quality": "good"}


@pytest.mark.parametrize(
    "change,reason",
    [
        ({}, None),
        ({"text": "ب", "clip_duration": 0.5}, "too_short_text"),
        ({"clip_duration": 0.99}, "under_min_duration"),
        ({"clip_duration": 1.0}, None),
        ({"clip_duration": 28.0}, None),
        ({"clip_duration": 28.01}, "over_max_duration"),
        ({"quality": "poor"}, "audio_quality:poor"),
        ({"silence_ratio": 0.6}, None),
        ({"silence_ratio": 0.61}, "too_silent"),
        ({"silence_ratio": None}, None),
        ({"chars_per_sec": 2.9}, "cps_too_low"),
        ({"chars_per_sec": 3.0}, None),
        ({"chars_per_sec": 28.0}, None),
        ({"chars_per_sec": 28.1}, "cps_too_high"),
        ({"chars_per_sec": None}, None),
        ({"text": "hello there"}, "not_persian"),
        ({"overlap_fraction": 0.6}, None),
        ({"overlap_fraction": 0.61}, "excess_overlap"),
    ],
)
def test_gates(spark, change, reason):
    row = {**BASE, **change}
    strict = replace(CFG, filt=replace(CFG.filt, require_audio_quality_good=True))
    df = spark.createDataFrame([tuple(row.values())], "text string, clip_duration double, silence_ratio double, chars_per_sec double, overlap_fraction double, quality string")
    assert df.select(gates.reject_reason(strict, F.col("clip_duration"), F.col("quality"))).first()[0] == reason
    loose = df.select(gates.reject_reason(CFG, F.col("clip_duration"), F.col("quality"))).first()[0]
    assert loose == (None if reason == "audio_quality:poor" else reason)


@pytest.mark.parametrize(
    "align,agree,overlap,cps,want,tier,weight",
    [
        (0.9, 0.9, 0.0, 10.0, 0.9, "accept", 1.0),
        (0.9, 0.8, 0.3, 10.0, 0.595, "review", 0.0),
        (0.7, None, 0.0, 10.0, 0.7, "downweight", 0.5),
        (None, 0.7, 0.0, 10.0, 0.7, "downweight", 0.5),
        (None, None, 0.0, 10.0, 0.5, "review", 0.0),
        (1.0, 1.0, 0.9, 10.0, 0.4, "review", 0.0),
        (1.0, 1.0, 0.0, 40.0, 0.6, "downweight", 0.5),
        (1.7, -1.0, 0.0, None, 0.5, "review", 0.0),
    ],
)
def test_confidence(spark, align, agree, overlap, cps, want, tier, weight):
    df = spark.createDataFrame([(align, agree, overlap, cps)], "a double, g double, o double, c double")
    c = scoring.confidence(CFG, *map(F.col, "agoc"))
    r = df.select(c.alias("c"), scoring.tier(CFG, c).alias("t"), scoring.loss_weight(CFG, c).alias("w")).first()
    assert r.c == pytest.approx(want) and (r.t, r.w) == (tier, weight)


@pytest.mark.parametrize("d,bucket,band", [(0.5, "under_min", "<3s"), (2.0, "long", "<3s"), (3.0, "short", "3-8s"), (8.0, "mid", "8-18s"), (18.0, "long", "18-28s"), (28.0, "long", "18-28s"), (28.5, "over_max", ">28s")])
def test_length_classes(spark, d, bucket, band):
    assert one(spark, gates.length_bucket(CFG, F.col("d")), d=d) == bucket
    assert one(spark, gates.duration_band(F.col("d")), d=d) == band


def test_manifest_row_outcomes(spark):
    rows = [(" Silence ", "", None), ("a", " ", "p"), ("a", "t", None), ("a", "t", "p"), (None, None, "p")]
    df = spark.createDataFrame(rows, "s string, t string, p string")
    args = [F.col(c) for c in "stp"]
    assert [r[0] for r in df.select(gates.row_outcome(*args)).collect()] == ["dropped_silence", "missing_text", "missing_audio", "kept", "missing_text"]
    assert df.select(gates.row_outcome(*args, keep_silence=True)).first()[0] == "missing_text"


def corpus(spark, n, crossed):
    rows = [(f"c{i:03d}", i, i < crossed, None if i == 0 else i / n) for i in range(n)]
    return spark.createDataFrame(rows, "call_id string, chunk_idx int, has_overlap boolean, confidence double")


def test_overlap_cap(spark):
    kept = manifest.cap_overlap(corpus(spark, 100, 20), CFG, ["chunk_idx"]).collect()
    assert len(kept) == 92 and {r.chunk_idx for r in kept if r.has_overlap} == set(range(8, 20))
    assert manifest.cap_overlap(corpus(spark, 100, 12), CFG, ["chunk_idx"]).count() == 100
    assert manifest.cap_overlap(corpus(spark, 100, 20), replace(CFG, overlap=replace(CFG.overlap, keep=False)), ["chunk_idx"]).count() == 80
    assert manifest.cap_overlap(corpus(spark, 5, 1), CFG, ["chunk_idx"]).count() == 4


def test_global_rank(spark):
    rows = [(i * 7919 % 1000, i % 3) for i in range(1000)] + [(5, None), (None, 1)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = global_rank(df, [F.col("b").desc(), F.col("a").asc()]).collect()
    want = sorted(rows, key=lambda r: (-(-1 if r[1] is None else r[1]), -1 if r[0] is None else r[0]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r["rank"])] == want and sorted(r["rank"] for r in got) == list(range(1002))
    assert global_rank(df.limit(0), [F.col("a")]).collect() == []


@pytest.mark.parametrize("n,want", [(100, 5), (20, 1), (10, 1), (1, 1)])
def test_split_sizes(spark, n, want):
    df = corpus(spark, n, 0)
    ids = [f"c{i:03d}" for i in range(n)]
    random.Random(1337).shuffle(ids)
    seeded = manifest.split_by_call(df, manifest.test_calls_by_shuffle(df, CFG))
    assert {r.call_id for r in seeded.where("split = 'test'").collect()} == set(ids[:want])
    hashed = manifest.split_by_call(df.union(df), manifest.test_calls_by_hash(df, CFG))
    sides = hashed.groupBy("call_id").agg(F.countDistinct("split").alias("n")).agg(F.max("n")).first()[0]
    assert sides == 1 and hashed.where("split = 'test'").count() == 2 * want
    assert manifest.n_test(0, CFG) == 0


def test_gold(spark):
    train = spark.createDataFrame([("a", 0.5, "accept")] * 3, "text string, loss_weight double, tier string")
    gold = spark.createDataFrame([("g", "2", 1), ("h", None, 2)], "text string, loss_weight string, extra int")
    got = manifest.merge_gold(train, gold, CFG).collect()
    assert len(got) == 9 and {(r.text, r.loss_weight) for r in got if r.tier == "gold"} == {("g", 2.0), ("h", 1.0)} and {r.source for r in got} == {None, "gold"}
    assert manifest.merge_gold(train, gold.drop("loss_weight"), replace(CFG, split=replace(CFG.split, gold_oversample=0))).count() == 5


def test_histogram(spark):
    got = reports.confidence_histogram(spark.createDataFrame([(0.29,), (0.999,), (1.0,), (None,), (0.95,)], "confidence double"))
    assert {r.bucket: (r.n, r.bar) for r in got.collect()} == {"0.2": (1, "#" * 20), "0.9": (2, "#" * 40), "1.0": (1, "#" * 20)}


def test_channels_are_taken_greedily(spark):
    rows = [("c", "A", 0, 5.0), ("c", "A", 1, 9.0), ("c", "B", 0, 1.0), ("c", "B", 1, 8.0), ("m", "A", 0, 1.0), ("m", "B", 0, 2.0)]
    got = signal.assign_channels(spark.createDataFrame(rows, "call_id string, speaker string, channel int, energy double")).collect()
    assert {(r.call_id, r.speaker): r.channel for r in got} == {("c", "A"): 1, ("c", "B"): 0, ("m", "A"): 0, ("m", "B"): 0}


def test_settings(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("chunk:\n  max_s: 20\n  unknown: 1\n  short_band: [2, 6]\nsplit:\nother: {}\n")
    s = load_settings(str(p))
    assert s.chunk.max_s == 20 and s.chunk.short_band == (2, 6) and s.split == CFG.split and s.to_dict()["filt"]["min_chars"] == 2
    p.write_text("")
    assert load_settings(str(p)) == load_settings() == overlay(CFG, None) == CFG


def test_matched_words_equal_difflib():
    import random
    from difflib import SequenceMatcher

    from voxloom.functions import text

    rng = random.Random(3)
    for k in range(300):
        words = [str(i) for i in range(rng.choice([2, 5, 40]))]
        a = [rng.choice(words) for _ in range(rng.randrange(60))]
        b = [w for w in a if rng.random() < 0.8] if k % 2 else [rng.choice(words) for _ in range(rng.randrange(60))]
        want = np.zeros(len(a), bool)
        for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks():
            want[m.a : m.a + m.size] = True
        assert np.array_equal(text.matched_words(a, b), want)
    most, text.MAX_PAIRS = text.MAX_PAIRS, 3
    try:
        assert text.matched_words(list("abcab"), list("xabyab")).tolist() == [True, True, False, True, True]
    finally:
        text.MAX_PAIRS = most


def test_matched_words_at_every_size_and_in_long_texts(monkeypatch):
    import random
    import time
    from difflib import SequenceMatcher

    from voxloom.functions import text

    rng = random.Random(1)
    for k in range(600):
        v = rng.randrange(1, 7)
        a = [str(rng.randrange(v)) for _ in range(rng.randrange(25))]
        b = [w for w in a if rng.random() < 0.8] + ["new"] if k % 3 == 0 else [str(rng.randrange(v)) for _ in range(rng.randrange(25))]
        monkeypatch.setattr(text, "MAX_PAIRS", rng.choice([0, 3, 30, 1 << 20]))
        monkeypatch.setattr(text, "MAX_RUN", rng.choice([2, 4, 64]))
        want = np.zeros(len(a), bool)
        for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks():
            want[m.a : m.a + m.size] = True
        assert np.array_equal(text.matched_words(a, b), want)
    monkeypatch.undo()
    a = [str(rng.randrange(50)) for _ in range(200_000)]
    for b, least in (([w for w in a if rng.random() < 0.9], 150_000), ([str(rng.randrange(50)) for _ in range(200_000)], 500)):
        began = time.perf_counter()
        assert text.matched_words(a, b).sum() > least and time.perf_counter() - began < 20


def test_agreement_divides_matched_by_all(spark):
    from voxloom.functions import text

    df = spark.createDataFrame([("a b c", "a x c")], "r string, h string")
    assert df.select(text.agreement(F.col("r"), F.col("h")).alias("a")).first().a.score == 2 / 3


def test_mean_duration_counts_absent_as_nothing(spark):
    from voxloom.operators import reports

    got = reports.totals(spark.createDataFrame([(3.0,), (None,), (6.0,)], "duration double")).first()
    assert (got.n_records, got.hours, got.mean_duration) == (3, 9 / 3600, 3.0)


def test_next_cut_looks_ahead_as_far_as_needed():
    from voxloom.operators import turns

    rng = np.random.default_rng(2)
    for _ in range(40):
        start = np.cumsum(rng.integers(1, 4, 400)).astype(float)
        end = start + rng.integers(0, 3, 400)
        for i in (0, 7, 399):
            got = turns.next_cut(start, end, i, 300.0, 50.0, 2.0)
            full = i + 1 + int(np.searchsorted(np.maximum.accumulate(end[i + 1 :]) - start[i] > 300.0, True))
            fit = [k for k in range(i + 1, full) if end[k - 1] - start[i] >= 50.0 and start[k] - end[k - 1] >= 2.0]
            assert got == (max(fit, key=lambda k: (start[k] - end[k - 1], -k)) if fit else full)


def test_rounding_is_pythons(spark):
    import random

    from voxloom.functions.numbers import python_round

    rng = random.Random(7)
    values = [0.0005, 0.0015, 0.0025, 1.0005, 2.6755, 2.675, 0.125, -0.0005, -0.0625, 0.0625, 1e15, 4503599627370.4965, 1e300, -1e22, 5e-324, 0.0, 1.0, 33.3335]
    values += [k / 16 for k in range(-40, 40)] + [k / 2000 for k in range(1, 400, 2)] + [rng.uniform(-1e4, 1e4) for _ in range(40_000)] + [rng.randrange(10**9) / 2000 for _ in range(40_000)]
    values += [rng.random() * 10 ** rng.randrange(-8, 14) for _ in range(20_000)]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").select("x", python_round(F.col("x"), 3).alias("r"), python_round(F.col("x"), 1).alias("s"))
    for r in df.collect():
        assert r.r == round(r.x, 3) and r.s == round(r.x, 1), r
    assert spark.range(1).select(python_round(F.lit(None).cast("double"), 3).alias("r")).first().r is None


def test_clip_lines_round_as_python(spark):
    from voxloom.sources.writers import clip_line

    values = [0.825, 0.855, 0.125, 0.375, 0.615, 0.1, 0.0, 1.0, None]
    df = spark.createDataFrame([(f"p{i}", "accept", v, "t") for i, v in enumerate(values)], "audio_path string, tier string, confidence double, text string")
    assert [r.v for r in df.select(clip_line().alias("v")).collect()] == [f"p{i}\taccept({v or 0:.2f})\tt" for i, v in enumerate(values)]


def test_the_seeded_split_shuffles_places_not_ids(spark):
    import random

    from voxloom.operators import manifest

    ids = [f"call {k * 7919 % 1000:04d} {chr(65 + k % 40)}" for k in range(331)] + ["", "é", "\U0001f600"]
    chunks = spark.createDataFrame([(i, k) for i in ids for k in range(2)], "call_id string, k int").repartition(3)
    shuffled = sorted(ids)
    random.Random(CFG.split.seed).shuffle(shuffled)
    want = shuffled[: max(1, int(len(ids) * CFG.split.test_fraction))]
    assert sorted(r[0] for r in manifest.test_calls_by_shuffle(chunks, CFG).collect()) == sorted(want)
    assert manifest.test_calls_by_shuffle(chunks.limit(0), CFG).collect() == []


def test_texts_matched_together_equal_each_alone(spark, monkeypatch):
    import random
    from difflib import SequenceMatcher

    from voxloom.functions import text

    rng, calls = random.Random(4), []
    monkeypatch.setattr(text, "ROWS", 60)
    monkeypatch.setattr(text, "WORDS", 300)
    kernel = text._matched_texts
    monkeypatch.setattr(text, "_matched_texts", lambda *a: calls.append(len(a[1]) - 1) or kernel(*a))
    refs, hyps = [], []
    for k in range(300):
        v = rng.choice([1, 2, 5, 40])
        a = [f"w{rng.randrange(v)}" for _ in range(rng.randrange(40))]
        b = [w for w in a if rng.random() < 0.8] if k % 2 else [f"w{rng.randrange(v)}" for _ in range(rng.randrange(40))]
        refs.append(" ".join(a))
        hyps.append(None if k % 7 == 0 else " ".join(b))
    got = text._matched.func(pa.array(refs), pa.array(hyps)).to_pylist()
    for r, h, g in zip(refs, hyps, got):
        a, there = r.split(), set()
        if h is None:
            assert g == {"score": None, "missed": []}
            continue
        for m in SequenceMatcher(None, a, h.split(), autojunk=False).get_matching_blocks():
            there |= set(range(m.a, m.a + m.size))
        assert g == {"score": len(there) / len(a) if a else None, "missed": [w for i, w in enumerate(a) if i not in there]}
    assert 5 < len(calls) < 150  # many texts a call
    assert text._matched.func(pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []
