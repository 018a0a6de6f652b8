"""Resampling, block codecs, spans of recordings and clips as files."""

import io
import struct

import numpy as np
import pytest

from tests.test_corpus import SR, wav
from voxloom.functions import audio, codecs
from voxloom.sources.audio import Sound
from voxloom.sources.clip_files import ClipWriter, write_clip_files


def riff(tag, n_channels, rate, block, bits, data, extra=b"", fact=None, junk=b""):
    fmt = struct.pack("<HHIIHH", tag, n_channels, rate, rate * block, block, bits) + extra
    parts = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"\0" * (len(fmt) % 2)
    if junk:
        parts += b"LIST" + struct.pack("<I", len(junk)) + junk + b"\0" * (len(junk) % 2)
    if fact is not None:
        parts += b"fact" + struct.pack("<II", 4, fact)
    parts += b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", 4 + len(parts)) + b"WAVE" + parts


def level(x):
    return 20 * np.log10(np.sqrt((x.astype(float) ** 2).mean()) + 1e-12)


def sine(f, rate, seconds=2.0):
    return np.sin(2 * np.pi * f * np.arange(int(rate * seconds)) / rate)[None]


@pytest.mark.parametrize("f,rate,target", [(12_000, 44_100, 16_000), (5_000, 44_100, 8_000), (9_000, 22_050, 16_000)])
def test_tones_above_the_new_band_are_gone(f, rate, target):
    y = audio.resample(sine(f, rate), rate, target)
    assert y.shape == (1, round(2 * rate * target / rate)) and level(y[0, 500:-500]) < level(sine(f, rate)) - 60
    assert level(audio.resample(sine(f, rate), rate, target, "linear")) > -20  # which is why it isn't the default


@pytest.mark.parametrize("f,rate,target", [(440, 8_000, 16_000), (1_000, 44_100, 16_000), (3_000, 8_000, 16_000), (3_000, 16_000, 11_025), (50, 48_000, 8_000)])
def test_tones_within_the_band_stay(f, rate, target):
    y = audio.resample(sine(f, rate), rate, target)
    want = np.sin(2 * np.pi * f * np.arange(y.shape[1]) / target)
    assert np.abs(y[0] - want)[400:-400].max() < 2e-3


def test_lengths_methods_and_empty_signals():
    for n in (0, 1, 7, 1001):
        for rate, target in ((44_100, 16_000), (8_000, 16_000), (7, 3)):
            for how in ("sinc", "linear") if n else ("sinc",):
                y = audio.resample(np.ones((2, n)), rate, target, how)
                assert y.shape == (2, round(n * target / rate)) and y.dtype == np.float32
    with pytest.raises(ValueError):
        audio.resample(np.ones((1, 9)), 8000, 16_000, "cubic")
    x = np.ones((1, 10))
    assert audio.resample(x, 5, 5) is x


def plain_ima(block, n_channels):
    """One block, code by code."""
    out = []
    for c in range(n_channels):
        value, index = struct.unpack_from("<hB", block, 4 * c)
        got = [value]
        for g in range(4 * n_channels, len(block), 4 * n_channels):
            for byte in block[g + 4 * c : g + 4 * c + 4]:
                for code in (byte & 15, byte >> 4):
                    step = int(codecs.IMA_STEPS[index])
                    d = step // 8 + (step // 4) * (code & 1) + (step // 2) * (code >> 1 & 1) + step * (code >> 2 & 1)
                    value = max(-32768, min(32767, value - d if code & 8 else value + d))
                    index = max(0, min(88, index + int(codecs.IMA_MOVES[code & 7])))
                    got.append(value)
        out.append(got)
    return np.array(out)


def plain_ms(block, n_channels):
    kinds = [min(k, 6) for k in block[:n_channels]]
    numbers = struct.unpack_from(f"<{3 * n_channels}h", block, n_channels)
    step, last, before = (list(numbers[k * n_channels : (k + 1) * n_channels]) for k in range(3))
    out = [[before[c], last[c]] for c in range(n_channels)]
    at = [code for byte in block[7 * n_channels :] for code in (byte >> 4, byte & 15)]
    for i, code in enumerate(at[: len(at) // n_channels * n_channels]):
        c = i % n_channels
        one, two = map(int, codecs.MS_PREDICTORS[kinds[c]])
        value = ((last[c] * one + before[c] * two) >> 8) + (code - 16 if code > 7 else code) * step[c]
        before[c], last[c] = last[c], max(-32768, min(32767, value))
        step[c] = max(16, int(codecs.MS_SCALES[code]) * step[c] >> 8)
        out[c].append(last[c])
    return np.array(out)


@pytest.mark.parametrize("n_channels", [1, 2])
def test_block_codecs_equal_a_loop(n_channels):
    rng = np.random.default_rng(n_channels)
    for kind, decode, plain, block in (("ima", codecs.decode_ima, plain_ima, 4 * n_channels * 9), ("ms", codecs.decode_ms, plain_ms, 7 * n_channels + 32)):
        rows = rng.integers(0, 256, (5, block), dtype=np.uint8)
        for c in range(n_channels):
            rows[:, 4 * c + 2 if kind == "ima" else c] %= 89 if kind == "ima" else 7
        got = decode(rows.tobytes(), n_channels, block)
        want = np.concatenate([plain(bytes(r), n_channels) for r in rows], axis=1)
        assert (got == want).all() and got.shape[1] == 5 * codecs.frames_per_block(kind, n_channels, block)
        for bad in (0, 3 * n_channels):
            with pytest.raises(ValueError):
                decode(rows.tobytes(), n_channels, bad or 4)


def test_hand_made_codes():
    # steps 7, then 16 (index 8 after one code of 7), up and down
    block = struct.pack("<hBB", 100, 0, 0) + bytes([0x07, 0x0F, 0, 0])
    assert codecs.decode_ima(block, 1, 8)[0, :4].tolist() == [100, 100 + 0 + 1 + 3 + 7, 111 + 2, 113 - (1 + 3 + 7 + 14)]
    # predictor 0 repeats the last sample, predictor 1 goes on in a line
    assert codecs.decode_ms(bytes([0]) + struct.pack("<hhh", 16, 50, 40) + bytes([0x0F]), 1, 8)[0].tolist() == [40, 50, 50, 50 - 16]
    assert codecs.decode_ms(bytes([1]) + struct.pack("<hhh", 16, 50, 40) + bytes([0x00]), 1, 8)[0].tolist() == [40, 50, 60, 70]


def recordings(rng):
    x = rng.normal(size=(2, 9_001)) * 0.2
    yield "pcm", wav(*x, rate=8_000)
    yield "pcm 24", wav(*x, rate=44_100, width=3)
    yield "mu-law", riff(7, 2, 8_000, 2, 8, rng.integers(0, 256, 18_002, dtype=np.uint8).tobytes(), junk=b"odd")
    yield "float", riff(3, 2, 16_000, 8, 32, x.T.astype("<f4").tobytes(), fact=9_001)
    block = rng.integers(0, 256, (40, 72), dtype=np.uint8)
    block[:, [2, 6]] %= 89
    yield "ima", riff(17, 2, 11_025, 72, 4, block.tobytes()[:-30], b"\2\0" + struct.pack("<H", 65), fact=40 * 65 - 20)
    yield "ms", riff(2, 1, 8_000, 256, 4, rng.integers(0, 7, (9, 256), dtype=np.uint8).tobytes(), b"\0\0")


def test_spans_equal_the_whole_recording():
    rng = np.random.default_rng(4)
    for name, content in recordings(rng):
        whole, rate = audio.decode_wav(content)
        read = []

        class Counting(io.BytesIO):
            def read(self, n=-1):
                read.append(n)
                return super().read(n)

        for target in (16_000, 8_000):
            full = audio.resample(whole, rate, target)
            for a, b, pad in ((0.0, 0.1, 0.15), (0.05, 0.06, 0.0), (0.2, 99.0, 0.1), (5.0, 6.0, 0.1), (0.1, 0.05, 0.0), (-1.0, 0.02, 0.01)):
                for channel in range(len(whole)):
                    sound = Sound("x.wav", None, target, opener=lambda _: Counting(content))
                    got, want = sound.cut(channel, a, b, pad), audio.cut(full[channel], target, a, b, pad)
                    assert got.shape == want.shape and np.allclose(got, want, atol=1e-6), (name, target, a, b)
                    sound.close()
        read.clear()
        sound = Sound("x.wav", None, 8_000, opener=lambda _: Counting(content))
        assert sound.by_span and len(sound.cut(0, 0.05, 0.06, 0.0)) == 80
        assert -1 not in read and sum(read) < len(content) / 2  # heads and a few bytes
        with_content = Sound("x.wav", content, 8_000)
        assert not with_content.by_span and np.allclose(with_content.cut(0, 0.05, 0.06, 0.0), sound.cut(0, 0.05, 0.06, 0.0), atol=1e-6)


def test_layouts():
    whole = wav(np.zeros(100), np.zeros(100), rate=SR)
    assert audio.decode_wav(whole[:-40])[0].shape == (2, 90)  # cut short
    unknown = whole[:40] + struct.pack("<I", 0xFFFFFFFF) + whole[44:]
    assert audio.decode_wav(unknown)[0].shape == (2, 100)  # of unknown length
    for bad in (b"", b"RIFF", whole[:30], riff(17, 1, 8000, 3, 4, b"abc"), riff(85, 1, 8000, 1, 0, b"abc"), riff(1, 0, 8000, 0, 16, b"abc")):
        with pytest.raises(ValueError):
            audio.decode_wav(bad)


def test_clips_become_files_all_or_none(spark, tmp_path):
    root = tmp_path / "out"
    rows = [(f"{root}/audio/{k % 3}/c{k}.wav", bytes([k])) for k in range(20)] + [("audio/rel.wav", b"r")]
    clips = spark.createDataFrame(rows, "path string, bytes binary").repartition(4)
    for _ in range(2):  # a second job replaces
        write_clip_files(clips, str(root))
        found = {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file()}
        assert found == {f"audio/{k % 3}/c{k}.wav": bytes([k]) for k in range(20)} | {"audio/rel.wav": b"r"}

    def fails(batches):
        for b in batches:
            if (b["path"] == "audio/rel.wav").any():
                raise RuntimeError("a task that fails")
            yield b

    for bad in (clips.mapInPandas(fails, clips.schema), spark.createDataFrame([("../outside.wav", b"x"), ("a.wav", b"y")], "path string, bytes binary")):
        with pytest.raises(Exception):
            write_clip_files(bad, str(tmp_path / "none"))
        assert not [p for p in (tmp_path / "none").rglob("*") if p.is_file() and "_staging" not in str(p)] and not (tmp_path / "outside.wav").exists()


def test_a_task_that_runs_twice_leaves_one_file(tmp_path):
    w = ClipWriter(str(tmp_path), ["path", "bytes"])
    lost = w.write(iter([("a/x.wav", b"half")]))
    kept = w.write(iter([("a/x.wav", b"whole")]))
    assert lost.folder != kept.folder and not (tmp_path / "a").exists()
    w.commit([kept, None])
    assert [p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()] == [b"whole"]
