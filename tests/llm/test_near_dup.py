"""Near-duplicate groups against brute force over all pairs."""

import random

import numpy as np
import pytest

from voxloom.llm import near_dup as nd
from voxloom.llm import sketches as sk
from voxloom.llm.components import components

RNG = random.Random(4)
WORDS = [f"w{i}" for i in range(300)]


def prose(n):
    return [RNG.choice(WORDS) for _ in range(n)]


def corpus():
    texts = []
    for _ in range(6):
        base = prose(RNG.choice([40, 120, 300]))
        texts.append(" ".join(base))
        for _ in range(8):  # chains: each copy edits the one before
            base = list(base)
            for _ in range(RNG.randrange(1, 4)):
                base[RNG.randrange(len(base))] = RNG.choice(WORDS)
            texts.append(" ".join(base))
    texts += [" ".join(prose(50)) for _ in range(20)] + [None, "", "  \n", "one two", "One  TWO", "a b c d", "same " * 30, "same " * 31]
    texts += texts[:5] + [texts[0].upper()]
    order = list(range(len(texts)))
    RNG.shuffle(order)
    return [(i * 3, texts[k]) for i, k in enumerate(order)]


def brute(rows):
    memo = sk.WordHashes()
    sets = {i: set(sk.shingles(t, memo).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("block", [512, 2])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, b"x", 1) for i, t in rows], "doc_id long, text string, node binary, n long").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.group_documents(docs).collect()}
    assert got == brute(rows)
    kept = nd.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, v in got.items() if v[2]}


def test_large_loose_group_needs_the_block_pass(spark, monkeypatch):
    """Copies of a base that is itself missing: linked only here and there."""
    monkeypatch.setattr(nd, "BLOCK", 16)
    base = prose(200)
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(RNG.choice([2, 3, 4])):
            copy[RNG.randrange(200)] = RNG.choice(WORDS)
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.group_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_odd_ids_and_empty(spark):
    schema = "doc_id long, text string"
    assert nd.group_documents(spark.createDataFrame([], schema)).collect() == []
    t = " ".join(prose(30))
    got = nd.group_documents(spark.createDataFrame([(None, t), (7, t), (7, t), (None, "solo"), (5, None)], schema)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (-1, 7, False), (5, 5, True), (7, 7, True), (7, 7, True)]


def test_filter_decides_by_row(spark):
    """Repeated rows, copies without an id, and a clean text that shares its id with a copy."""
    a, b, c, d = (" ".join(prose(30)) for _ in range(4))
    rows = [(7, a, 0), (7, a, 0), (None, a, 1), (None, b, 2), (None, b, 2), (9, c, 3), (9, a, 4), (3, d, 5), (None, None, 6), (4, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tag int").repartition(3)
    kept = nd.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.tag) for r in kept.collect()) == [(-1, 2), (-1, 6), (3, 5), (4, 7), (7, 0), (9, 3)]


def test_threshold_of_the_pipeline(spark):
    """A planted copy at 0.82: the pipeline's stage drops it, op6 keeps it."""
    pipeline = pytest.importorskip("corpus_pipeline")
    base = [f"v{i}" for i in range(104)]  # 100 shingles
    edited = base[:20] + ["new"] + base[21:80] + ["other"] + base[81:]
    rows = [(i, " ".join(t)) for i, t in enumerate([base, edited, base[4:-14], prose(90)])]
    memo = sk.WordHashes()
    sets = [set(sk.shingles(t, memo).tolist()) for _, t in rows]
    near = [len(sets[0] & s) / len(sets[0] | s) for s in sets]
    assert 0.81 <= near[1] < 0.83 and 0.81 <= near[2] < 0.83 and near[3] == 0
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in pipeline.keep_distinct(spark, docs, "").collect()) == [0, 3]
    assert all(r.kept for r in nd.group_documents(docs).collect())


def test_bands_of_a_threshold():
    assert nd.band_rows(85) == sk.ROWS and nd.band_rows(80) == 5
    for t in (70, 80, 85, 90):
        r = nd.band_rows(t)
        assert (1 - (t / 100) ** r) ** (sk.SIZE // r) < nd.MISS
    x = sk.sketch(np.arange(50, dtype=np.uint64))
    assert len(sk.band_keys(x)) == sk.BANDS and len(set(sk.band_keys(x, 5).tolist())) == 38


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 3, 50, 2000):
        assert sk.sketch(np.unique(rng.integers(0, 2**63, n).astype(np.uint64))).max() < np.iinfo(np.uint64).max
    errors = []
    for _ in range(40):
        both, one, two = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (300, 30, 20))
        a, b = np.unique(np.concatenate([both, one])), np.unique(np.concatenate([both, two]))
        errors.append((sk.sketch(a) == sk.sketch(b)).mean() - 300 / 350)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.15


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 103), (200, 200)]
    RNG.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 105: 100, 103: 100}


def test_sql_says_the_same():
    import duckdb
    import pandas as pd

    from voxloom.llm import oracles

    rows = corpus()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"text": object}))
    got = con.sql(oracles.NEAR_DUP).fetchall()
    assert {i: (n, c, kept) for i, n, c, kept in got} == brute(rows)


def test_large_star_and_shared_text(spark, monkeypatch):
    """A hub of many streams, ids that repeat with other texts, and a text that many rows without id share."""
    monkeypatch.setattr(nd, "STREAM", 3)
    monkeypatch.setattr(nd, "BLOCK", 4)
    base = prose(150)
    rows = [(i, " ".join(base[:100] + [f"z{i}"] + base[101:])) for i in range(40)]
    other = " ".join(prose(60))
    rows += [(None, other)] * 20 + [(500, other), (500, " ".join(prose(30))), (500, rows[3][1])]
    got = nd.group_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.component_id for r in got if r.doc_id is not None and r.doc_id < 40} == {0}
    assert [r.component_id for r in got if r.doc_id is None] == [500] * 20
    assert sorted(r.component_id for r in got if r.doc_id == 500) == [0, 500, 500]
