"""Numpy kernels on single recordings, used inside Arrow functions."""

from __future__ import annotations

import io
import math
import struct
import wave
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from . import codecs

FRAME_MS, THRESHOLD_DB = 30, -35.0


#: Format tags of RIFF recordings.
PCM, MS_ADPCM, FLOAT, A_LAW, MU_LAW, IMA_ADPCM, EXTENSIBLE = 1, 2, 3, 6, 7, 17, 0xFFFE

#: Reads ``n`` bytes from a place on, fewer at the end.
Reader = Callable[[int, int], bytes]


@dataclass(frozen=True)
class Layout:
    """How the samples of a RIFF recording lie in it: units of ``unit`` bytes with ``frames`` samples of each channel."""

    tag: int
    n_channels: int
    rate: int
    width: int
    unit: int
    frames: int
    n_frames: int
    data: int
    size: int


def wav_layout(read: Reader) -> Layout:
    """The layout from the heads of the chunks; the samples themselves aren't read.

    The first chunk of a name counts; a data chunk of unknown length reaches to the end.
    """
    head = read(0, 12)
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("no RIFF recording")
    format_, data, counted, at = b"", None, None, 12
    while len(head := read(at, 8)) == 8:
        name, size = head[:4], struct.unpack("<I", head[4:])[0]
        if name == b"fmt " and not format_:
            format_ = read(at + 8, min(size, 64))
        elif name == b"fact" and counted is None and size >= 4:
            counted = struct.unpack("<I", read(at + 8, 4))[0]
        elif name == b"data" and data is None:
            data = (at + 8, size)
            if size >= 0x7FFFFFFF or format_ and counted is not None:
                break
        at += 8 + size + size % 2
    if len(format_) < 16 or data is None:
        raise ValueError("a recording without format or data")
    tag, n_channels, rate, _, block, bits = struct.unpack_from("<HHIIHH", format_)
    if tag == EXTENSIBLE and len(format_) >= 26:
        tag = struct.unpack_from("<H", format_, 24)[0]
    begin, size = data
    size = min(size, _end(read, begin, size) - begin)
    if tag in (IMA_ADPCM, MS_ADPCM):
        kind = "ima" if tag == IMA_ADPCM else "ms"
        if not n_channels or bits != 4 or block < 8 * n_channels:
            raise ValueError(f"format {tag} with {bits} bits and blocks of {block} bytes isn't read here")
        frames = codecs.frames_per_block(kind, n_channels, block)
        n_frames = -(-size // block) * frames
        return Layout(tag, n_channels, rate, 0, block, frames, min(n_frames, counted) if counted else n_frames, begin, size)
    width = bits // 8
    if not n_channels or not rate or (tag, width) not in {(PCM, 1), (PCM, 2), (PCM, 3), (PCM, 4), (FLOAT, 4), (FLOAT, 8), (A_LAW, 1), (MU_LAW, 1)}:
        raise ValueError(f"format {tag} with {bits} bits isn't read here")
    return Layout(tag, n_channels, rate, width, n_channels * width, 1, size // (n_channels * width), begin, size)


def _end(read: Reader, begin: int, size: int) -> int:
    """Where the data really ends: files may be cut short, or name a length that they don't have."""
    if not size or read(begin + size - 1, 1):
        return begin + size
    low, high = begin, begin + size - 1  # the end lies in [low, high]
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if read(middle, 1) else (low, middle)
    return low


def decode_range(read: Reader, layout: Layout, first: int, end: int) -> np.ndarray:
    """(channels x samples in float32) of the samples [first, end), which must lie in the recording; only their bytes are read."""
    if end <= first:
        return np.zeros((layout.n_channels, 0), np.float32)
    a, b = first // layout.frames, -(-end // layout.frames)
    raw = read(layout.data + a * layout.unit, min(b * layout.unit, layout.size) - a * layout.unit)
    x = _samples(raw, layout)
    return np.ascontiguousarray(x[:, first - a * layout.frames : end - a * layout.frames], dtype=np.float32)


def expand_mu_law(code: np.ndarray) -> np.ndarray:
    """14-bit samples of mu-law bytes (G.711): inverted bits of sign, exponent and mantissa, with a bias of 33."""
    c = ~code
    size = (((c & 15).astype(np.int32) * 2 + 33) << ((c >> 4) & 7)) - 33
    return np.where(c & 0x80, -size, size)


def expand_a_law(code: np.ndarray) -> np.ndarray:
    """13-bit samples of A-law bytes (G.711): every second bit inverted, the lowest exponent without a leading bit."""
    c = code ^ 0x55
    e = ((c >> 4) & 7).astype(np.int32)
    size = (c & 15).astype(np.int32) * 2 + 1
    size = np.where(e > 0, (size + 32) << np.maximum(e - 1, 0), size)
    return np.where(c & 0x80, size, -size)


def _samples(raw: bytes, layout: Layout) -> np.ndarray:
    tag, width = layout.tag, layout.width
    if tag in (IMA_ADPCM, MS_ADPCM):
        return (codecs.decode_ima if tag == IMA_ADPCM else codecs.decode_ms)(raw, layout.n_channels, layout.unit) / 32768
    raw = raw[: len(raw) // layout.unit * layout.unit]
    if tag == FLOAT:
        x = np.frombuffer(raw, f"<f{width}").astype(np.float64)
    elif tag == MU_LAW:
        x = expand_mu_law(np.frombuffer(raw, np.uint8)) / 8192
    elif tag == A_LAW:
        x = expand_a_law(np.frombuffer(raw, np.uint8)) / 4096
    elif width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / 8388608
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]) / float(1 << (8 * width - 1))
    return x.reshape(-1, layout.n_channels).T


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(channels x samples in float32, rate) of a RIFF file: PCM of 8, 16, 24 or 32 bits, floats, A-law, mu-law, or ADPCM of IMA or Microsoft.

    Other codecs are a ``decoder`` of the caller's.
    """
    read = lambda at, n: content[at : at + n]
    layout = wav_layout(read)
    return decode_range(read, layout, 0, layout.n_frames), layout.rate


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """One channel as 16-bit PCM."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.clip(np.rint(x * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


#: Zero crossings of the windowed sinc on either side, and the shape of its Kaiser window (some 80 dB of rejection).
CROSSINGS, BETA = 32, 8.0
#: Share of the lower rate's band that passes unweakened.
PASS = 0.94
#: Output samples that are made at once.
BLOCK = 1 << 14


@lru_cache(maxsize=16)
def _phases(up: int, down: int) -> tuple[np.ndarray, int]:
    """(filter taps by phase, taps on either side) for a change of rate by up / down."""
    cutoff = PASS * min(1.0, up / down)
    side = int(np.ceil(CROSSINGS / cutoff))
    at = np.arange(-side, side + 1)[None, :] - np.arange(up)[:, None] / up  # distance of each input sample from the output's place
    taps = cutoff * np.sinc(cutoff * at) * np.i0(BETA * np.sqrt(np.clip(1 - (at / (side + 1)) ** 2, 0, 1))) / np.i0(BETA)
    return taps / taps.sum(axis=1, keepdims=True), side


def resampled_length(n: int, rate: int, target: int) -> int:
    return n if rate == target else int(round(n * target / rate))


def inputs_of(first: int, end: int, rate: int, target: int) -> tuple[int, int]:
    """The input samples on which the outputs [first, end) of ``resample`` by ``sinc`` depend (they may pass the ends)."""
    if rate == target:
        return first, end
    shared = math.gcd(rate, target)
    up, down = target // shared, rate // shared
    _, side = _phases(up, down)
    return first * down // up - side, (max(end - 1, first)) * down // up + side + 1


def resample_part(part: np.ndarray, at: int, first: int, end: int, rate: int, target: int) -> np.ndarray:
    """Outputs [first, end) of ``resample`` by ``sinc``, from the inputs that begin with sample ``at``; others count as silent."""
    if rate == target:
        return np.asarray(part[:, first - at : end - at], np.float32)
    shared = math.gcd(rate, target)
    up, down = target // shared, rate // shared
    taps, side = _phases(up, down)
    out = np.empty((len(part), max(end - first, 0)), np.float32)
    for a in range(first, end, BLOCK):
        place = np.arange(a, min(a + BLOCK, end), dtype=np.int64) * down
        low, high = int(place[0] // up) - side - at, int(place[-1] // up) + side + 1 - at
        wide = np.pad(part[:, max(low, 0) : max(high, 0)].astype(np.float64), ((0, 0), (max(-low, 0) - max(-high, 0), 0)))
        wide = np.pad(wide, ((0, 0), (0, high - low - wide.shape[1])))
        windows = np.lib.stride_tricks.sliding_window_view(wide, 2 * side + 1, axis=1)
        out[:, a - first : a - first + len(place)] = np.einsum("cnk,nk->cn", windows[:, place // up - place[0] // up], taps[place % up])
    return out


def resample(x: np.ndarray, rate: int, target: int, method: str = "sinc") -> np.ndarray:
    """Every channel at the target's rate, ``round(n * target / rate)`` samples.

    ``sinc`` is band-limited: a polyphase filter of windowed sincs, one set of taps for each place that an output can
    have between two inputs; beyond the ends a signal is silent.  ``linear`` interpolates on a grid of the same ends.
    """
    if rate == target:
        return x
    n = resampled_length(x.shape[1], rate, target)
    if method == "linear":
        old, new = np.linspace(0, 1, x.shape[1]), np.linspace(0, 1, n)
        return np.stack([np.interp(new, old, c) for c in x]).astype(np.float32)
    if method != "sinc":
        raise ValueError(f"resampling is 'sinc' or 'linear', not {method!r}")
    return resample_part(x, 0, 0, n, rate, target)


def speech_regions(x: np.ndarray, rate: int, frame_ms: int = FRAME_MS, threshold: float = THRESHOLD_DB) -> np.ndarray:
    """Rows (start, end) in seconds of runs of frames above the energy threshold; the ragged tail is ignored."""
    frame = max(1, rate * frame_ms // 1000)
    n = len(x) // frame
    rms = np.sqrt((x[: n * frame].reshape(n, frame).astype(np.float64) ** 2).mean(axis=1) + 1e-10) if n else np.zeros(0)
    active = np.concatenate([[0], (20 * np.log10(rms + 1e-10) > threshold).astype(np.int8), [0]])
    edges = np.diff(active)
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], axis=1) * frame / rate


def silence_share(x: np.ndarray, rate: int) -> float:
    if not len(x):
        return 1.0
    spoken = np.diff(speech_regions(x, rate), axis=1).sum()
    return float(max(0.0, 1.0 - spoken / (len(x) / rate)))


def trim_edges(x: np.ndarray, rate: int, margin: float) -> np.ndarray:
    """Without leading and trailing silence but for a margin; silence inside stays, and so does a clip without speech."""
    r = speech_regions(x, rate)
    if not len(r):
        return x
    a, b = int(max(0.0, r[0, 0] - margin) * rate), int(min(len(x) / rate, r[-1, 1] + margin) * rate)
    return x[a:b] if b > a else x


def sample_range(n: int, rate: int, start: float, end: float, pad: float) -> tuple[int, int]:
    """First sample and end of a padded span of a signal with n samples."""
    return max(0, int((start - pad) * rate)), max(0, min(n, int((end + pad) * rate)))


def cut(x: np.ndarray, rate: int, start: float, end: float, pad: float) -> np.ndarray:
    a, b = sample_range(len(x), rate, start, end, pad)
    return x[a:b]


def level_db(x: np.ndarray) -> float:
    if not len(x):
        return float("-inf")
    return float(20 * np.log10(np.sqrt((x.astype(np.float64) ** 2).mean() + 1e-12) + 1e-12))


def energies(channels: np.ndarray, rate: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of squares of every segment (rows) in every channel, from running sums."""
    total = np.concatenate([np.zeros((len(channels), 1)), np.cumsum(channels.astype(np.float64) ** 2, axis=1)], axis=1)
    clip = lambda t: np.clip((np.asarray(t, float) * rate).astype(np.int64), 0, channels.shape[1])
    a, b = clip(starts), clip(ends)
    return np.maximum(total[:, np.maximum(a, b)] - total[:, a], 0).T


def assign_channels(energy: dict[str, np.ndarray]) -> dict[str, int]:
    """Speakers in order of their loudest channel take the loudest one that is free, else their loudest."""
    taken: set[int] = set()
    out = {}
    for name in sorted(energy, key=lambda s: (-energy[s].max(), s)):
        ranked = sorted(range(len(energy[name])), key=lambda c: (-energy[name][c], c))
        out[name] = next((c for c in ranked if c not in taken), ranked[0])
        taken.add(out[name])
    return out
