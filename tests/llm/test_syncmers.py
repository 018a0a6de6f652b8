"""Closed syncmers against a plain definition, and the successor rule against a loop."""

import hashlib
import random
import time

import numpy as np

from voxloom.llm import syncmers as sy


def plain(text):
    small, large = sy.gram_hashes(sy.code_points(text), sy.S, sy.K)
    found = []
    for i in range(len(text) - sy.K + 1):
        inner = [int(small[j]) for j in range(i, i + sy.K - sy.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.append((i, int(large[i]) >> 32))
    return found


def texts():
    rng = random.Random(1)
    words = ["the", "of", "thinger", "ération", "\U0001f600", "stheat", "ou"]
    made = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 5, 8, 30, 200, 400)]
    return made + ["a" * 300, made[5], None, "x" * 31, "y" * 32]


def test_anchors_follow_the_definition(monkeypatch):
    have = [t or "" for t in texts()]
    for piece in (1 << 19, 50):
        monkeypatch.setattr(sy, "PIECE", piece)
        for t, (at, h) in zip(have, sy.anchors(have)):
            if len(t) >= sy.K:
                assert list(zip(at.tolist(), h.tolist())) == plain(t)


def test_gap_guarantee_and_context_freedom():
    t = "".join(random.Random(3).choice("abcdefgh ") for _ in range(5000))
    at, h = sy.anchors([t])[0]
    assert np.diff(at).max() <= sy.K - sy.S + 1
    moved, g = sy.anchors(["zz top " + t])[0]
    assert set(zip((at + 7).tolist(), h.tolist())) <= set(zip(moved.tolist(), g.tolist()))


def test_successors_cover_every_cell(spark, monkeypatch):
    monkeypatch.setattr(sy, "ROWS_PER_CELL", 2)
    have = texts()
    ids = [3, 10, 11, 12, 500, 501, 9000, 9001, 9002, 9003, 90000, 90001]
    rows = list(zip(ids, have, ["c"] * len(ids)))
    got = {r.doc_id: r for r in sy.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string, cell string").repartition(3)).collect()}
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        t, nxt = have[k] or "", have[(k + 1) % len(ids)] or ""
        e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        a, b, c = (x[1] for x in sy.anchors([t, e, nxt]))
        assert got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].fingerprint == sy.pack(*sy.anchors([t])[0]) and got[i].edited_fingerprint == sy.pack(*sy.anchors([e])[0])
        assert (got[i].near_edited, got[i].near_next) == (sy.likeness(a, b), sy.likeness(a, c))
    assert got[501].fingerprint == got[9002].fingerprint


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sy.fingerprint_edits(empty).collect() == []
    one = sy.fingerprint_edits(spark.createDataFrame([(None, "abc")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    same = sy.fingerprint_edits(spark.createDataFrame([(1, "abc")] * 3 + [(None, None)], "doc_id long, text string")).collect()
    assert len(same) == 4


def test_likeness_is_the_longest_chain():
    a, b = np.array([1, 2, 3, 4, 5, 6]), np.array([9, 3, 4, 1, 6])
    assert sy.likeness(a, b) == 2 * 3 / 11
    assert sy.likeness(a, a) == 1.0 and sy.likeness(a, a[:0]) == 0.0


def test_likeness_equals_the_full_table_with_repeats(monkeypatch):
    rng = np.random.default_rng(4)
    for pairs in (1 << 22, 0):  # by pairs, by bits
        monkeypatch.setattr(sy, "PAIRS", pairs)
        assert sy.likeness(np.array([1, 2]), np.array([2, 1, 2])) == 0.8
        for _ in range(60):
            a, b = (rng.integers(0, rng.integers(1, 12), rng.integers(0, 40)) for _ in range(2))
            table = np.zeros((len(a) + 1, len(b) + 1), int)
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
            total = len(a) + len(b)
            assert sy.likeness(a, b) == (2 * table[-1, -1] / total if total else 1.0)
    monkeypatch.setattr(sy, "PAIRS", 1 << 22)
    a, b = np.repeat(np.arange(4), 5000), np.repeat(np.arange(3, -1, -1), 5000)
    assert sy.likeness(a, b) == 0.25


def loop(rows):
    """Result of every row by a loop over all rows in order of key, then hash of the text."""
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        a, b, c = (x[1] for x in sy.anchors([t, e, nxt]))
        out.append((i is not None, i or 0, len(t), hashlib.sha256(e.encode()).hexdigest(), sy.likeness(a, b), sy.likeness(a, c)))
    return sorted(out)


def test_skewed_ids_spread_and_follow_the_loop(spark, monkeypatch):
    """An outlying id, null ids and many equal rows: same successors as a loop, and no cell that holds most rows."""
    monkeypatch.setattr(sy, "ROWS_PER_CELL", 20)
    rng = random.Random(2)
    text = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(30, 90)))
    outlying = [(i, text()) for i in range(600)] + [(1 << 60, text())]
    null = [(None, text()) for _ in range(500)] + [(i, text()) for i in range(100)]
    equal = [(7, "the same line of text again and again")] * 400 + [(None, "same")] * 200 + [(i, text()) for i in range(300)]
    sizes = []
    deal = sy._stream

    def counted(batches, *rest):
        held = list(batches)
        by = {}
        for b in held:
            for c in zip(b.column("cell").to_pylist(), b.column("stream").to_pylist()):
                by[c] = by.get(c, 0) + 1
        open(f"{folder}/{rng.random()}-{id(held)}", "w").write(str(max(by.values(), default=0)))
        return deal(iter(held), *rest)

    import os
    import tempfile

    for rows in (outlying, null, equal):
        folder = tempfile.mkdtemp()
        monkeypatch.setattr(sy, "_stream", counted)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = sy.fingerprint_edits(docs).collect()
        monkeypatch.setattr(sy, "_stream", deal)
        h = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
        ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h[r[1]]))
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got) == loop(ordered)
        sizes.append(max(int(open(f"{folder}/{f}").read()) for f in os.listdir(folder)))
    assert max(sizes) < 150, sizes


def full_table(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        before = 0
        for j, b in enumerate(y, 1):
            before, row[j] = row[j], before + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def test_chains_by_runs_equal_the_full_table(monkeypatch):
    rng = random.Random(21)
    for k in range(300):
        few = rng.randrange(1, 4)
        some = lambda: np.array([h for _ in range(rng.randrange(1, 7)) for h in [rng.randrange(few)] * rng.choice([1, 2, 9])], np.int64)  # noqa: E731, B023
        x, y = some(), some()
        assert sy._chain_of_runs(x, y) == full_table(x.tolist(), y.tolist())
        if set(x.tolist()) == set(y.tolist()):
            for pairs, cost in ((0, 0), (0, 10**9), (10**9, 1)):
                monkeypatch.setattr(sy, "PAIRS", pairs)
                monkeypatch.setattr(sy, "RUN_COST", cost)
                assert sy._chain(x, y) == full_table(x.tolist(), y.tolist())


def test_long_constant_stretches_are_quick():
    rng = np.random.default_rng(3)
    own = [rng.integers(10, 1 << 32, 500) for _ in range(3)]
    blank, dash = np.full(4_000_000, 5), np.full(2_000_000, 6)
    a = np.concatenate([own[0], blank, own[1], dash, own[2]])
    b = np.concatenate([own[1], dash[:900_000], blank[:3_000_000], own[0], dash, own[2][:100]])
    began = time.perf_counter()
    got = sy.likeness(a, b)
    assert time.perf_counter() - began < 20
    # blanks and dashes in order beat every other chain: 3,000,000 + 2,000,000, then the common end of the last part
    assert np.isclose(got, 2 * (3_000_000 + 2_000_000 + 100) / (len(a) + len(b)))
