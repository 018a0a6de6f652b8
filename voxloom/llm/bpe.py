"""A byte-level BPE vocabulary, read once on the driver and shipped to the tasks.

The vocabulary file is a fixed artefact of a few megabytes (``MAX_BYTES`` is checked), so it may
be broadcast.  Executors need no copy of the file.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import lru_cache

#: The most bytes a vocabulary file may have to be broadcast.
MAX_BYTES = 64 << 20

#: Fixed value: the pattern by which byte-level BPE splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id (merge order is id order) and the ids of special strings."""

    tokens: tuple[bytes, ...]
    specials: tuple[tuple[str, int], ...]


@lru_cache(maxsize=4)
def _read(path: str, stamp: tuple[int, int]) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, letters = spec["model"], byte_letters()
    raw = lambda s: bytes(letters[c] for c in s)
    by_id = sorted((i, raw(s)) for s, i in model["vocab"].items())
    if [i for i, _ in by_id] != list(range(len(by_id))):
        raise ValueError("the ids of the vocabulary have gaps")
    tokens = [t for _, t in by_id]
    first = len(tokens) - len(model["merges"])
    for k, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        if raw(left) + raw(right) != tokens[first + k]:
            raise ValueError("merge order differs from id order; ids can't serve as ranks")
    added = tuple((a["content"], a["id"]) for a in spec["added_tokens"])
    if spec["normalizer"] or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
        raise ValueError("only plain byte-level BPE is known here")
    return Vocabulary(tuple(tokens), added)


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary in a byte-level BPE ``.json``; raises if its ids don't rank its merges."""
    s = os.stat(path)
    if s.st_size > MAX_BYTES:
        raise ValueError(f"{path} has {s.st_size} bytes; at most {MAX_BYTES} may be broadcast")
    return _read(path, (s.st_size, s.st_mtime_ns))


@lru_cache(maxsize=4)
def encoder(vocab: Vocabulary):
    """The merger of this vocabulary, built once in each Python worker."""
    import tiktoken

    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(vocab.tokens)}, special_tokens={})


def special_splitter(vocab: Vocabulary):
    """A pattern that finds special strings, the longest first; None without any."""
    import re

    found = sorted((s for s, _ in vocab.specials), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None
