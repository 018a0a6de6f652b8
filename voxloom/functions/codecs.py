"""Block codecs of RIFF recordings: IMA and Microsoft ADPCM, all blocks of a recording side by side.

A block begins with its own state, so blocks don't depend on each other: one step of the loop decodes one sample of every
block and channel.
"""

from __future__ import annotations

import numpy as np

#: Step sizes of IMA ADPCM and how a code moves the step's index.
IMA_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371,
    408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132,
    7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
])
IMA_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8])
#: Predictors of Microsoft ADPCM (in 256ths) and how a code scales the step (in 256ths).
MS_PREDICTORS = np.array([(256, 0), (512, -256), (0, 0), (192, 64), (240, 0), (460, -208), (392, -232)])
MS_SCALES = np.array([230, 230, 230, 230, 307, 409, 512, 614, 768, 614, 512, 409, 307, 230, 230, 230])


def frames_per_block(kind: str, n_channels: int, block: int) -> int:
    """Samples of each channel in a block of so many bytes."""
    if kind == "ima":
        return (block - 4 * n_channels) * 2 // n_channels + 1
    return (block - 7 * n_channels) * 2 // n_channels + 2


def _whole_blocks(raw: bytes, block: int) -> np.ndarray:
    """Blocks as rows of bytes; a last one that is cut short is filled up with zeros."""
    n = -(-len(raw) // block)
    return np.frombuffer(raw.ljust(n * block, b"\0"), np.uint8).reshape(n, block)


def _int16(pairs: np.ndarray) -> np.ndarray:
    """Little-endian 16-bit numbers from the last axis' pairs of bytes."""
    return np.ascontiguousarray(pairs).view("<i2")[..., 0].astype(np.int64)


def decode_ima(raw: bytes, n_channels: int, block: int) -> np.ndarray:
    """(channels x samples) of 16-bit samples: each code is three bits of size and one of sign, in steps that grow and shrink."""
    if block <= 4 * n_channels or (block - 4 * n_channels) % (4 * n_channels):
        raise ValueError(f"blocks of {block} bytes don't hold {n_channels} channels")
    blocks = _whole_blocks(raw, block)
    head = blocks[:, : 4 * n_channels].reshape(-1, n_channels, 4)
    value, index = _int16(head[:, :, :2]), np.minimum(head[:, :, 2].astype(np.int64), len(IMA_STEPS) - 1)
    body = blocks[:, 4 * n_channels :].reshape(len(blocks), -1, n_channels, 4).transpose(0, 2, 1, 3).reshape(len(blocks), n_channels, -1)
    codes = np.stack([body & 15, body >> 4], axis=-1).reshape(len(blocks), n_channels, -1).astype(np.int64)
    out = np.empty((len(blocks), n_channels, codes.shape[2] + 1), np.int16)
    out[:, :, 0] = value
    for t in range(codes.shape[2]):
        code, step = codes[:, :, t], IMA_STEPS[index]
        change = (step >> 3) + np.where(code & 1, step >> 2, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 4, step, 0)
        value = np.clip(value + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + IMA_MOVES[code & 7], 0, len(IMA_STEPS) - 1)
        out[:, :, t + 1] = value
    return out.transpose(1, 0, 2).reshape(n_channels, -1)


def decode_ms(raw: bytes, n_channels: int, block: int) -> np.ndarray:
    """(channels x samples) of 16-bit samples: each code corrects a prediction from the last two samples."""
    if block < 7 * n_channels:
        raise ValueError(f"blocks of {block} bytes don't hold {n_channels} channels")
    blocks = _whole_blocks(raw, block)
    kind = np.minimum(blocks[:, :n_channels], len(MS_PREDICTORS) - 1)
    step, last, before = (_int16(blocks[:, a * n_channels : (a + 2) * n_channels].reshape(-1, n_channels, 2)) for a in (1, 3, 5))
    body = blocks[:, 7 * n_channels :]
    codes = np.stack([body >> 4, body & 15], axis=-1).reshape(len(blocks), -1)
    codes = codes[:, : codes.shape[1] // n_channels * n_channels].reshape(len(blocks), -1, n_channels).astype(np.int64)
    one, two = MS_PREDICTORS[kind, 0], MS_PREDICTORS[kind, 1]
    out = np.empty((len(blocks), n_channels, codes.shape[1] + 2), np.int16)
    out[:, :, 0], out[:, :, 1] = before, last
    for t in range(codes.shape[1]):
        code = codes[:, t]
        value = ((last * one + before * two) >> 8) + np.where(code > 7, code - 16, code) * step
        last, before = np.clip(value, -32768, 32767), last
        step = np.maximum((MS_SCALES[code] * step) >> 8, 16)
        out[:, :, t + 2] = last
    return out.transpose(1, 0, 2).reshape(n_channels, -1)
