"""Sources, sinks and the audio plans on generated recordings."""

import io
import json
import os
import pathlib
import struct
import wave
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import audio
from voxloom.plans import aligned_path, diagnose, training_table, turn_path
from voxloom.plans.plugins import Plugins, ctc_aligner, ctc_scorer
from voxloom.settings import Settings
from voxloom.sources import calls, manifests, writers
from voxloom.sources.audio import decode, read_recordings
from voxloom.streaming import turns as stream_turns
from voxloom.operators import manifest, turns

SR = 16_000
CFG = Settings()


def tone(parts, seconds, rate=SR, level=0.5):
    x = np.zeros(int(seconds * rate))
    for a, b in parts:
        x[int(a * rate) : int(b * rate)] = level
    return x


def wav(*channels, rate=SR, width=2):
    x = np.stack(channels, axis=1)
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(x.shape[1])
        f.setsampwidth(width)
        f.setframerate(rate)
        if width == 1:
            raw = np.rint(x * 127 + 128).astype("u1").tobytes()
        elif width == 3:
            raw = b"".join(int(v).to_bytes(3, "little", signed=True) for v in np.rint(x * 8388607).ravel())
        else:
            raw = np.rint(x * ((1 << (8 * width - 1)) - 1)).astype(f"<i{width}").tobytes()
        f.writeframes(raw)
    return out.getvalue()


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_decode_all_widths(width):
    x, rate = audio.decode_wav(wav(tone([(0.1, 0.2)], 0.3), tone([], 0.3), width=width))
    assert x.shape == (2, 4800) and rate == SR and x.dtype == np.float32
    assert abs(x[0, 2000] - 0.5) < 0.01 and abs(x[1]).max() < 0.01


def test_kernels():
    x = tone([(2, 3), (6, 7)], 10)
    r = audio.speech_regions(x, SR)
    assert np.allclose(r, [[1.98, 3.0], [6.0, 7.02]])
    clip = audio.trim_edges(x, SR, 0.2)
    assert 5.43 < len(clip) / SR < 5.45 and len(audio.trim_edges(np.zeros(3 * SR), SR, 0.2)) == 3 * SR
    assert audio.silence_share(np.ones(SR), SR) == pytest.approx(0.01) and audio.silence_share(np.zeros(0), SR) == 1.0
    assert audio.speech_regions(np.ones(100), SR).shape == (0, 2) and audio.speech_regions(np.ones(SR), SR).tolist() == [[0.0, 0.99]]
    assert audio.level_db(np.zeros(0)) == float("-inf") and abs(audio.level_db(np.ones(9))) < 1e-6
    assert audio.resample(np.ones((2, 800)), 8000, SR).shape == (2, 1600)
    back, rate = audio.decode_wav(audio.encode_wav(x, SR))
    assert rate == SR and np.abs(back[0] - x).max() < 1e-3
    e = audio.energies(np.stack([tone([(0, 1)], 2), tone([(1, 2)], 2)]), SR, np.array([0.0, 1.0, 1.5, -1.0]), np.array([1.0, 2.0, 1.0, 9.0]))
    assert np.allclose(e, [[4000, 0], [0, 4000], [0, 0], [4000, 4000]])
    assert audio.assign_channels({"Customer": e[0], "Expert": e[1]}) == {"Customer": 0, "Expert": 1}


def test_call_documents(spark):
    t = {"start": "1.5", "end": 2, "text": None, "overlap": "false"}
    docs = {
        "a": {"analysis": {"transcript": []}, "transcript": [t]},
        "b": {"analysis": "x", "raw_response": {"transcript": [t, {**t, "speaker": " E ", "text": " hi\t", "overlap": 0}], "audio_quality": "good"}},
        "c": {},
        "d": {"audio_file": {"ccplatform_url": "", "id": "A"}, "transcript": [{"end": 1, "text": "x"}]},
        "e": {"audio_file": None, "request_id": "R", "transcript": "nonsense"},
    }
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in docs.items()] + [("f", "{broken")], "stem string, raw string")
    rows = rows.select("stem", F.try_parse_json("raw").alias("call"))
    ids = {r.stem: r.id for r in rows.select("stem", calls.call_id(F.col("call"), F.col("stem")).alias("id")).collect()}
    assert ids == {"a": "a", "b": "b", "c": "c", "d": "A", "e": "R", "f": "f"}
    segs = calls.segments(rows.select(F.col("stem").alias("call_id"), "call")).orderBy("call_id", "seg_idx").collect()
    assert [(r.call_id, r.seg_idx, r.start, r.end, r.text, r.speaker, r.overlap, r.bad_call) for r in segs] == [
        ("a", 0, 1.5, 2.0, "", "", True, False),
        ("b", 0, 1.5, 2.0, "", "", True, False),
        ("b", 1, 1.5, 2.0, "hi", "E", False, False),
        ("d", 0, None, 1.0, "x", "", False, True),
        ("e", 0, None, None, "", "", False, True),  # something that is no list ends the search and spoils the call
    ]
    odd = [{"analysis": {"transcript": {"a": 1}}, "transcript": [t]}, {"analysis": {"transcript": 0}, "transcript": [t]}, {"raw_response": {"transcript": "x"}, "transcript": [t]}]
    rows = spark.createDataFrame([(str(i), json.dumps(d)) for i, d in enumerate(odd)], "call_id string, raw string").select("call_id", F.try_parse_json("raw").alias("call"))
    assert {(r.call_id, r.bad_call) for r in calls.segments(rows).collect()} == {("0", True), ("1", False), ("2", True)}


def test_pairing(spark):
    names = ["a/x.json", "a/x.wav", "a/y.wav", "b/report.json", "b/z.wav", "c/report.json", "c/1.wav", "c/2.wav", "d/q.json"]
    got = calls.pair_files(spark.createDataFrame([(f"/r/{n}",) for n in names], "path string")).collect()
    assert {(r.json_path[3:], r.wav_path and r.wav_path[3:], r.skip_reason) for r in got} == {
        ("a/x.json", "a/x.wav", None), ("b/report.json", "b/z.wav", None), ("c/report.json", None, "ambiguous"), ("d/q.json", None, "no wav"),
    }


def test_pairs_are_ordered_by_the_parts_of_their_paths(spark):
    paths = [f"/c/{n}" for n in ("a-b/1.json", "a/1.json", "a.b/x.json", "a/b/1.json", "a b/1.json", "b.json", "A/1.json")]
    want = [str(p) for p in sorted(map(pathlib.PurePosixPath, paths))]
    rows = spark.createDataFrame([(p,) for p in reversed(paths)], "json_path string")
    for n in (1, 3, 7):
        assert [r[0] for r in calls.first_calls(rows, n).collect()] == want[:n]
    # equal confidences: the cap keeps the chunks of the first pairs, whatever the calls' own ids
    chunks = [(own, pair, k, True, 0.5) for own, pair in (("aaa", "/c/a-b/1.json"), ("zzz", "/c/a/1.json")) for k in range(10)] + [("m", "/c/m.json", k, False, 0.5) for k in range(80)]
    chunks = spark.createDataFrame(chunks, "call_id string, pair string, chunk_idx int, has_overlap boolean, confidence double").repartition(3)
    kept = manifest.cap_overlap(chunks, CFG, [calls.path_order("pair"), "chunk_idx"]).where("has_overlap").collect()
    assert sorted((r.call_id, r.chunk_idx) for r in kept) == [("aaa", 0), ("aaa", 1)] + [("zzz", k) for k in range(10)]


TALK = [
    {"start": 0, "end": 4, "text": "سلام وقت شما بخیر باشد", "speaker": "Expert"},
    {"start": 4, "end": 8, "text": "سلام ممنون از تماس شما", "speaker": "Customer"},
    {"start": 8, "end": 12, "text": "درباره سفارش شما تماس گرفتم", "speaker": "Expert", "overlap": True},
    {"start": 12, "end": 13, "text": "hello there friend", "speaker": "Customer"},
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for i in range(4):
        left, right = tone([(0.3, 3.8), (8.2, 11.9)], 14), tone([(4.2, 7.9), (12.0, 13.0)], 14)
        (root / f"c{i}").mkdir()
        (root / f"c{i}" / "report.json").write_text(json.dumps({"transcript": TALK, "request_id": f"call/{i}"}), encoding="utf-8")
        (root / f"c{i}" / f"rec{i}.wav").write_bytes(wav(*((left, right) if i % 2 else (right, left))))
    for name, doc, sound in (("bad", {"transcript": [{"text": "x"}]}, wav(tone([], 1))), ("deaf", {"transcript": TALK}, b"not a recording"), ("mute", {}, wav(tone([], 1))), ("alone", {"transcript": TALK}, None)):
        (root / name).mkdir()
        (root / name / f"{name}.json").write_text(json.dumps(doc), encoding="utf-8")
        if sound:
            (root / name / f"{name}.wav").write_bytes(sound)
    return str(root)


def test_turn_path(spark, folder, tmp_path):
    gold = tmp_path / "gold.jsonl"
    gold.write_text(json.dumps({"text": "طلا", "audio_path": "g.wav"}) + "\n", encoding="utf-8")
    plugins = Plugins(scorer=lambda: lambda text, x, rate: 0.9, transcriber=lambda: lambda x, rate: "سلام وقت شما بخیر باشد" if len(x) % 2 == 0 else None)
    stats = turn_path.run(spark, folder, str(tmp_path / "out"), CFG, plugins, str(gold), files=True).first()
    listed = [r.audio_path for r in spark.read.json([f"{tmp_path}/out/train.jsonl", f"{tmp_path}/out/test.jsonl"]).where("tier != 'gold'").select("audio_path").collect()]
    assert len(listed) == 8 - 0 and all(audio.decode_wav(open(p, "rb").read())[1] == SR for p in listed)
    assert (stats.calls, stats.calls_skipped, stats.chunks_kept, stats.after_overlap_cap) == (7, 2, 8, 8)
    assert (stats.train, stats.test) == (6, 2) and stats.rejected == {"excess_overlap": 4, "not_persian": 4}
    clips = spark.read.parquet(f"{tmp_path}/out/clips").orderBy("call_id", "chunk_idx").collect()
    first = clips[0]
    assert (first.call_id, first.speaker, first.channel, first.segment_indices) == ("call/0", "Expert", 1, [0])
    assert 3.5 < first.clip_duration < 4.4 and first.silence_ratio < 0.2
    assert [c.channel for c in clips if c.call_id == "call/1"] == [0, 0, 1, 1]
    train = spark.read.json(f"{tmp_path}/out/train.jsonl")
    assert train.where("source = 'gold'").count() == 3 and train.where("tier = 'gold'").count() == 3
    assert set(turn_path.MANIFEST) <= set(train.columns)
    skipped = {r.value.rsplit("/", 1)[-1] for r in spark.read.text(f"{tmp_path}/out/skipped_calls.txt").collect()}
    assert skipped == {"bad.wav", "deaf.wav"}

    scored = spark.read.parquet(f"{tmp_path}/out/scored").join(spark.read.parquet(f"{tmp_path}/out/clips").select("call_id", "chunk_idx", "samples"), ["call_id", "chunk_idx"])
    table = writers.clip_table(scored, SR)
    counts = training_table.run(spark, f"{tmp_path}/out", table, f"{tmp_path}/table").collect()
    assert {(r.split, r.outcome): r.n for r in counts} == {("train", "kept"): stats.train, ("train", "missing_audio"): 3, ("test", "kept"): stats.test}
    rows = spark.read.parquet(f"{tmp_path}/table")
    assert rows.count() == 8 and rows.select("audio.sampling_rate").first()[0] == SR
    x, rate = audio.decode_wav(bytes(rows.select("audio.bytes").first()[0]))
    assert rate == SR and x.shape[0] == 1
    with pytest.raises(FileNotFoundError):
        manifests.split_files(spark, str(tmp_path), ["train"])


def test_aligned_path(spark, folder, tmp_path):
    def align():
        def words(x, rate, text):
            if "ممنون" in text and x[int(4.5 * rate)] == 0:
                raise RuntimeError("nothing heard")
            return [(w, i * 1.0, i + 0.8, None if i else 0.5) for i, w in enumerate(text.split())]

        return words

    stats = aligned_path.run(spark, folder, str(tmp_path / "out"), Plugins(word_aligner=align), CFG, keep_prepared=True).first()
    prep = spark.read.parquet(f"{tmp_path}/out/prepared").collect()
    assert len(prep) == 8 and all(audio.decode_wav(bytes(r.bytes))[0].shape == (1, 14 * SR) and r.text_path == r.path[:-3] + "txt" and r.text for r in prep)
    assert stats.chunks_kept == stats.train + stats.test == 8 and stats.dropped_short == 0
    lines = sorted(r.value for r in spark.read.text(f"{tmp_path}/out/clips.tsv").collect())
    assert len(lines) == 8 and lines[0].split("\t")[0].endswith("call_0_Customer_000.wav") and "accept(0.9" in lines[0]
    reasons = [r.value for r in spark.read.text(f"{tmp_path}/out/skipped_calls.txt").collect()]
    assert len(reasons) == 2 and all("\t" in r for r in reasons)
    with pytest.raises(ValueError):
        aligned_path.run(spark, folder, "x", Plugins())


class Loud:
    """Emissions of a voice that can't be understood: any letter where it is loud, else the blank."""

    vocabulary = {c: i for i, c in enumerate("ابتدرسشفلمنوهیپگ", 1)}

    def __call__(self, x, rate):
        frame = rate // 50
        loud = np.sqrt((x[: len(x) // frame * frame].reshape(-1, frame) ** 2).mean(axis=1)) > 0.1
        p = np.full((len(loud), len(self.vocabulary) + 1), 0.002)
        p[:, 1:][loud] = 0.9 / len(self.vocabulary)
        p[~loud, 0] = 0.9
        return np.log(p), 0.02


def test_aligned_path_from_emissions(spark, folder, tmp_path):
    stats = aligned_path.run(spark, folder, str(tmp_path / "out"), Plugins(word_aligner=ctc_aligner(Loud)), CFG).first()
    words = spark.read.parquet(f"{tmp_path}/out/words")
    assert stats.calls_skipped == 2 and words.where("error is not null").count() == 0
    rows = words.select("call_id", "speaker", F.inline("words")).collect()
    assert {r.text for r in rows if r.speaker == "Expert"} == set((TALK[0]["text"] + " " + TALK[2]["text"]).split())
    for r in rows:  # letters lie where the speaker's channel is loud
        parts = [(0.3, 3.8), (8.2, 11.9)] if r.speaker == "Expert" else [(4.2, 7.9), (12.0, 13.0)]
        if set(r.text) & set(Loud.vocabulary):  # the others are stars, which may be any sound
            assert all(any(a - 0.1 <= t <= b + 0.1 for a, b in parts) for t in (r.start, r.end)), r


def test_turn_path_scored_from_emissions(spark, folder, tmp_path):
    turn_path.run(spark, folder, str(tmp_path / "out"), CFG, Plugins(scorer=ctc_scorer(Loud), vad=lambda: lambda x, rate: np.zeros((1, 3)))).first()
    scored = spark.read.parquet(f"{tmp_path}/out/scored").collect()
    assert scored and all(0.04 < r.alignment_score < 0.07 for r in scored)  # one of sixteen letters where it is loud; the odd detector's shape is no failure


def test_diagnose(spark, folder, tmp_path):
    t = diagnose.run(spark, f"{folder}/c1", dump_to=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/clips").count() == 2
    assert {r.value.split("\t")[0] for r in spark.read.text(f"{tmp_path}/_text.tsv").collect()} == {"chunk_00_Expert.wav", "chunk_02_Customer.wav"}
    assert {(r.speaker, r.channel) for r in t["mapping"].collect()} == {("Expert", 0), ("Customer", 1)}
    assert all(r.share > 0.99 for r in t["energy"].collect() if (r.speaker, r.channel) in {("Expert", 0), ("Customer", 1)})
    assert [r.status for r in t["chunks"].orderBy("chunk_idx").collect()] == ["KEEP", "DROP[excess_overlap]", "KEEP", "DROP[not_persian]"]
    assert t["turns"].count() == 2 and t["channels"].count() == 2


def test_decoder_errors_are_rows(spark, folder):
    rows = decode(read_recordings(spark, folder), 8000).collect()
    assert sum(r.error is not None for r in rows) == 1 and {r.rate for r in rows if r.error is None} == {8000}


def test_jsonl_keeps_nulls_and_counts(spark, tmp_path):
    n = writers.write_jsonl(spark.createDataFrame([("é", None), ("b", 1)], "t string, x int"), f"{tmp_path}/m.jsonl")
    assert n == 2 and '{"t":"é","x":null}' in {r.value for r in spark.read.text(f"{tmp_path}/m.jsonl").collect()}


def test_streams_equal_batch(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows, t = [], 0.0
    for i in range(60):
        t += float(rng.choice([0.2, 1.0, 5.0]))
        rows.append(("c", "E", "x", False, i, t, t + 0.5))
        t += 0.5
    kind = "call_id string, speaker string, text string, overlap boolean, seg_idx int, start double, end double"
    df = spark.createDataFrame(rows, kind)
    for k in range(3):
        df.where(f"seg_idx >= {20 * k} and seg_idx < {20 * k + 20}").coalesce(1).write.parquet(f"{tmp_path}/in/b{k}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    q = stream_turns.group_turns(stream, CFG).writeStream.format("memory").queryName("grouped").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = {(r.seg_idx, r.group_idx) for r in turns.assign_groups(df, CFG).collect()}
    assert {(r.seg_idx, r.group_idx) for r in spark.table("grouped").collect()} == want
    m = stream_turns.append_manifest(stream.select("call_id", "seg_idx"), f"{tmp_path}/man", f"{tmp_path}/cp")
    m.awaitTermination(120)
    assert spark.read.json(f"{tmp_path}/man").count() == 60
    timed = stream.select("call_id", "speaker", "text", F.timestamp_millis((F.col("start") * 1000).cast("long")).alias("ts"))
    s = stream_turns.gap_sessions(timed, "3 seconds", "1 second").writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).start()
    s.awaitTermination(120)
    assert spark.table("sessions").agg(F.sum("n_turns")).first()[0] <= 60


def test_command_line(spark, folder, tmp_path, capsys):
    from voxloom.__main__ import main

    main(["build", "--corpus", folder, "--out", str(tmp_path / "o"), "--no-align", "--no-second-asr"])
    main(["stats", f"{tmp_path}/o/train.jsonl"])
    main(["diagnose", "--dir", f"{folder}/c0"])
    said = capsys.readouterr().out
    assert "excess_overlap" in said and "review" in said and "=== mapping ===" in said


def test_channels_follow_from_whole_signals(spark, tmp_path):
    """A speaker who is loud only later in the signal has the most energy of the call."""
    from voxloom.plans import queries

    early, late = [0.4] * 16 + [0.0] * 48, [0.0] * 16 + [0.4] * 48
    rows = [(0, early, 1), (1, [0.01] * 64, 1), (2, late, 1), (3, [0.01] * 64, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.speaker, r.channel) for r in queries.queries()["q19_channel_assign"](spark, str(tmp_path)).collect()}
    assert got == {("caller", 0), ("agent", 1)}


def test_calls_that_share_an_id_stay_apart(spark, tmp_path):
    """Two pairs whose documents name the same request give the chunks of two calls, with clips of their own."""
    root = tmp_path / "c"
    sound = wav(tone([(0.3, 3.8), (8.2, 11.9)], 14), tone([(4.2, 7.9), (12.0, 13.0)], 14))
    for name in ("one", "two"):
        (root / name).mkdir(parents=True)
        (root / name / "report.json").write_text(json.dumps({"transcript": TALK, "request_id": "same"}), encoding="utf-8")
        (root / name / f"{name}.wav").write_bytes(sound)
    stats = turn_path.run(spark, str(root), str(tmp_path / "out"), CFG).first()
    assert (stats.calls, stats.calls_skipped, stats.chunks_kept) == (2, 0, 4)
    scored = spark.read.parquet(f"{tmp_path}/out/scored").collect()
    assert {r.call_id for r in scored} == {"same"} and len({r.pair for r in scored}) == 2 and len({r.audio_path for r in scored}) == 4
    assert sorted(tuple(r.segment_indices) for r in scored) == [(0,), (0,), (1,), (1,)]
    sides = [spark.read.json(f"{tmp_path}/out/{s}.jsonl").count() for s in ("train", "test") if os.path.getsize(_part(tmp_path / "out" / f"{s}.jsonl"))]
    assert sides == [4]  # calls of one id are on one side


def _part(folder):
    return max(folder.glob("part-*"), key=os.path.getsize)


def test_build_then_table(spark, folder, tmp_path):
    from voxloom.__main__ import main

    o = f"{tmp_path}/o"
    main(["build", "--corpus", folder, "--out", o, "--no-align", "--no-second-asr"])
    main(["table", "--manifest", o, "--clips", f"{o}/recordings", "--out", f"{tmp_path}/t"])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 8
    # the same clips as files, and a split that isn't there
    (tmp_path / "o" / "audio").mkdir()
    for r in spark.read.parquet(f"{o}/recordings").collect():
        with open(r.path, "wb") as f:
            f.write(bytes(r.bytes))
    main(["table", "--manifest", o, "--clips", f"{o}/audio", "--out", f"{tmp_path}/u", "--splits", "train,test,extra"])
    assert spark.read.parquet(f"{tmp_path}/u").count() == 8
    # a path relative to the manifest's folder, and one to its parent; rows without the usual columns
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.wav").write_bytes(wav(tone([], 1)))
    (tmp_path / "m" / "train.jsonl").write_text('{"audio_path": "a.wav", "text": "x"}\n{"audio_path": "m/a.wav", "text": "y"}\n{"audio_path": "b.wav", "text": "z"}\n', encoding="utf-8")
    main(["table", "--manifest", f"{tmp_path}/m/train.jsonl", "--clips", f"{tmp_path}/m", "--out", f"{tmp_path}/v"])
    assert {r.text for r in spark.read.parquet(f"{tmp_path}/v").collect()} == {"x", "y"}
    main(["stats", f"{tmp_path}/m/train.jsonl"])


def test_other_formats_of_recordings():
    """Companded and float samples, and the extensible header, against the definition of G.711."""
    codes = np.arange(256, dtype=np.uint8)
    mu, a = audio.expand_mu_law(codes), audio.expand_a_law(codes)
    assert mu[0xFF] == 0 and mu[0x80] == 8031 and mu[0x00] == -8031 and (mu[:128] == -mu[128:]).all()
    assert a[0xD5] == 1 and a[0x55] == -1 and a[0xAA] == 4032 and (a[:128] == -a[128:]).all()
    assert len(np.unique(mu)) == 255 and len(np.unique(a)) == 256

    def riff(tag, bits, raw, n_ch=2, extra=b""):
        fmt = struct.pack("<HHIIHH", tag, n_ch, 8000, 8000 * n_ch * bits // 8, n_ch * bits // 8, bits) + extra
        body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"data" + struct.pack("<I", len(raw)) + raw
        return b"RIFF" + struct.pack("<I", len(body)) + body

    x, rate = audio.decode_wav(riff(audio.MU_LAW, 8, codes.tobytes()))
    assert rate == 8000 and x.shape == (2, 128) and np.allclose(x[0], mu[::2] / 8192) and np.allclose(audio.decode_wav(riff(audio.A_LAW, 8, codes.tobytes()))[0][1], a[1::2] / 4096)
    y = np.linspace(-1, 1, 8, dtype="<f4")
    assert np.allclose(audio.decode_wav(riff(audio.FLOAT, 32, y.tobytes(), 1))[0][0], y)
    wide = struct.pack("<HHI", 22, 16, 3) + struct.pack("<H", audio.PCM) + b"\0" * 14
    assert np.allclose(audio.decode_wav(riff(audio.EXTENSIBLE, 16, np.array([16384, -16384], "<i2").tobytes(), 1, wide))[0][0], [0.5, -0.5])
    for raw in (b"", b"RIFF0000WAVE", riff(0x31, 16, b"\0" * 8), riff(audio.PCM, 16, b"")[:30]):
        with pytest.raises((ValueError, struct.error)):
            audio.decode_wav(raw)


def test_detector_falls_back_and_batches_fall_apart(spark):
    from voxloom.plans import plugins as pl

    def broken():
        raise RuntimeError("no model")

    x = tone([(0.3, 0.6)], 1)
    for plugin in (broken, lambda: lambda x, rate: broken()):
        assert np.array_equal(pl.detector(plugin)(x, SR), audio.speech_regions(x, SR))
    assert pl.detector(lambda: lambda x, rate: [(0, 1)])(x, SR).tolist() == [[0.0, 1.0]]

    class Model:
        def __call__(self, x, rate):
            if len(x) == 3:
                broken()
            return f"one {len(x)}"

        def batch(self, clips, rate):
            if any(len(x) == 3 for x in clips):
                broken()
            return [f"batch of {len(clips)}" for _ in clips]

    rows = [(i, bytes(2 * n) if n else None) for i, n in enumerate([1, 2, 0, 4, 5, 3, 6])]
    df = spark.createDataFrame(rows, "i int, s binary").coalesce(1)
    got = {r.i: r.t for r in df.select("i", pl.transcript_column(Model, "s", SR, 2).alias("t")).collect()}
    assert got == {0: "batch of 2", 1: "batch of 2", 2: None, 3: "batch of 2", 4: "batch of 2", 5: None, 6: "one 6"}


def test_split_method_is_checked_first(spark, monkeypatch):
    from voxloom.operators import manifest

    digest = replace(CFG, split=replace(CFG.split, method="digest"))
    monkeypatch.setattr(manifest, "MAX_SHUFFLED_CALLS", 3)
    manifest.check_split(3, CFG), manifest.check_split(10**9, digest)
    for n, cfg in ((4, CFG), (1, replace(CFG, split=replace(CFG.split, method="x")))):
        with pytest.raises(ValueError):
            manifest.check_split(n, cfg)
    rows = spark.createDataFrame([(str(i),) for i in range(40)], "call_id string")
    assert manifest.test_calls(rows, digest).count() == 2


def test_manifest_for_audio_loaders_and_short_clips(spark):
    from voxloom.functions import gates

    m = spark.createDataFrame([("a.wav", "x")], "audio_path string, text string")
    assert writers.for_audio_training(m).columns == ["audio", "text"]
    rows = spark.createDataFrame([(0.0, 0.9, None), (0.0, 5.0, 0.99), (0.0, 0.5, 1.0), (2.0, 3.0, None)], "start double, end double, clip_duration double")
    kept = rows.where(~(gates.effective_duration() < CFG.chunk.min_s))
    assert sorted((r.end, r.clip_duration) for r in kept.collect()) == [(0.5, 1.0), (3.0, None)]
