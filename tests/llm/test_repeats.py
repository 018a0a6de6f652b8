"""Substring dedup against a loop over all windows; the index against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from voxloom.llm import bits, repeats, words
from voxloom.llm.fm_index import FMIndex, WaveletMatrix

SCHEMA = "doc_id long, text string, n_words string, piece int"


def loop(rows, window=50):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    least = {}
    order = {i: (i is None, i or 0) for i, _ in split}
    for i, ws in split:
        for a in range(len(ws) - window + 1):
            w = tuple(ws[a : a + window])
            least[w] = min(least.get(w, order[i]), order[i])
    out = []
    for i, ws in split:
        gone = set()
        for a in range(len(ws) - window + 1):
            if least[tuple(ws[a : a + window])] < order[i]:
                gone.update(range(a, a + window))
        left = " ".join(w for a, w in enumerate(ws) if a not in gone)
        out.append((i, len(ws), len(gone), left, hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(n=120):
    rng = random.Random(2)
    vocabulary = [f"{rng.choice('abcdéf')}{rng.randrange(300)}" for _ in range(400)]
    some = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passages = [some(k) for k in (49, 50, 51, 60, 130, 300)]
    out = []
    for i in range(n):
        ws = some(rng.randrange(120))
        for _ in range(rng.randrange(3)):
            at, p = rng.randrange(len(ws) + 1), rng.choice(passages)
            cut = rng.randrange(10)
            ws = ws[:at] + p[cut : len(p) - rng.randrange(3)] + ws[at:]
        out.append((i * 3 % n, rng.choice([" ", "\n", "\t ", "\x0b"]).join(ws), "x", 1))
    out += [(500 + i, out[i % 5][1], "x", 1) for i in range(30)]  # copies
    out += [(3, out[3][1], "x", 1), (None, out[4][1], "x", 1), (None, out[4][1], "x", 1), (600, None, "x", 1), (601, "", "x", 1), (602, " \n ", "x", 1)]
    return out + [(603, "same " * 400, "x", 1), (604, "same " * 70 + "end", "x", 1), (605, "Same " * 60, "x", 1)]


@pytest.mark.parametrize("more", [{}, {"hot": 3, "shard": 10}, {"hot": 1, "run": 5}, {"window": 8, "run": 3, "hot": 2}])
def test_repeats_equal_a_loop(spark, more):
    have = rows()
    df = repeats.remove_repeats(spark.createDataFrame(have, SCHEMA).repartition(6), **more)
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"]
    assert sorted(map(tuple, df.collect()), key=str) == loop(have, more.get("window", 50))


def test_streams_slices_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STREAM", 7)
    monkeypatch.setattr(repeats, "PIECE", 5)
    monkeypatch.setattr(repeats, "MET", 3)
    rng = random.Random(6)
    long = [f"w{rng.randrange(3000)}" for _ in range(40_000)]
    have = [(1, " ".join(long), "x", 1), (2, " ".join(long[5000:5200] + ["q"] + long[9000:30_000]), "x", 1), *rows(30)[:20]]
    have = [(i + 10 if n > 1 and i is not None else i, *r) for n, (i, *r) in enumerate(have)]
    df = repeats.remove_repeats(spark.createDataFrame(have, SCHEMA).repartition(3))
    assert sorted(map(tuple, df.collect()), key=str) == loop(have)


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_wavelet_ranks():
    rng = np.random.default_rng(0)
    for n, k in ((1, 1), (5, 2), (500, 37), (1000, 64)):
        s = rng.integers(0, k, n)
        m = WaveletMatrix(s, k)
        c, at = rng.integers(0, k, 300), rng.integers(0, n + 1, 300)
        assert m.rank(c, at).tolist() == [int((s[:a] == x).sum()) for x, a in zip(c, at)]


def test_index_against_plain_search():
    rng = random.Random(1)
    for window in (3, 4, 7):
        for _ in range(15):
            some = lambda n: [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]
            texts = [some(rng.randrange(1, 25)) for _ in range(rng.randrange(1, 8))]
            own = [rng.randrange(50) for _ in texts]
            index = FMIndex(texts, own, window)
            asked = [some(rng.randrange(0, 30)) + rng.choice([[], [b"z"], [b"a"]]) + some(rng.randrange(0, 12)) for _ in range(6)]
            length, least = index.first_documents(asked, 99)
            for q, got_length, got in zip(asked, length, least):
                holds = lambda w: [d for t, d in zip(texts, own) if any(t[i : i + len(w)] == w for i in range(len(t) - len(w) + 1))]
                want = [min(holds(q[i : i + window]), default=99) if i + window <= len(q) else 99 for i in range(len(q))]
                assert got.tolist() == want
                for i, n in enumerate(got_length):
                    assert holds(q[i : i + n])
                    assert (n >= window) == (want[i] != 99)


def test_rolling_and_bits(spark):
    codes = words.word_hashes(__import__("pyarrow").array([b"a", b"b", b"c"]))[np.array([0, 1, 2, 0, 1, 2, 0])]
    h = words.rolling(codes, 3)
    assert len(h) == 5 and h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 3
    assert len(words.rolling(codes, 8)) == 0 and len(words.rolling(codes, 7)) == 1
    rng = np.random.default_rng(4)
    for n in (0, 1, 5000):
        own = rng.integers(-(1 << 63), 1 << 63, n)
        found = bits.bits_of(spark.createDataFrame([(int(x),) for x in own], "code long"), "code")
        assert found.has(own.view(np.uint64)).all()
        assert found.has(rng.integers(0, 1 << 63, 4000).view(np.uint64) * np.uint64(3)).mean() < 0.06
