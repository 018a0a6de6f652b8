"""Quality and toxicity: definitions on small data, odd rows, and held-out accuracy on planted text."""

import itertools
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import quality, toxicity
from voxloom.llm.labelled import remainder

RNG = random.Random(6)
WORDS = ["rein", "the", "hation", "oured", "blehe", "stand", "andre", "onwhat", "thing", "lyst"]


def good():
    return "\n".join(" ".join(RNG.choice(WORDS) for _ in range(RNG.randrange(5, 20))) + "." for _ in range(RNG.randrange(1, 8)))


def bad():
    kind = RNG.randrange(3)
    w = [RNG.choice(WORDS) for _ in range(60)]
    return [" ".join(x + "###" for x in w), " | ".join(w), " ".join(x.upper() + "!!" for x in w)][kind]


def table(spark, n=240):
    rows = [(i, bad() if i % 4 == 0 else good(), "zz") for i in range(n)] + [(9001, None, "zz"), (9002, "", "zz"), (None, good(), "zz"), (3, good(), "zz")]
    labels = [(i, int(i % 4 != 0), int(i % 5 == 0)) for i in range(n)] + [(None, 1, 1), (7777, 0, 0), (4, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, label string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_learns_and_filters(spark):
    docs, labels = table(spark)
    model = quality.fit(docs, labels, allowed=remainder("doc_id", 3) != 1)
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    judged = [(r.doc_id % 4 != 0) == bool(r.predicted) for r in got if r.doc_id is not None and r.doc_id < 9000]
    assert np.mean(judged) > 0.95
    kept = quality.drop_bad(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    n_lines = np.array([3, 1, 4])
    e, trans = rng.normal(size=8), rng.normal(size=(2, 2))
    p, pairs, log_z = quality.marginals(e, n_lines, trans)
    want_p, want_pairs, want_z, at = [], np.zeros((2, 2)), 0.0, 0
    for n in n_lines:
        total, mass, joint = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            s = np.exp(sum(e[at + t] for t in range(n) if path[t]) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            total += s
            mass += s * np.array(path)
            for a, b in zip(path, path[1:]):
                joint[a, b] += s
        want_p += list(mass / total)
        want_pairs += joint / total
        want_z += np.log(total)
        at += n
    assert np.allclose(p, want_p) and np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_line_measures_follow_lines():
    steps, size, n = quality.measure(["A b\n\nc|d", "", "é"])
    assert n.tolist() == [3, 1, 1] and size.tolist() == [3, 0, 3, 0, 2] and steps.shape == (5, quality.N_STEPS)


def test_ordinal_fit_shares_weights_and_orders_thresholds():
    rows = [[0]] * 30 + [[1]] * 30 + [[1, 2]] * 30 + [[1, 2, 3]] * 30
    grades = np.repeat([0, 1, 2, 3], 30)
    w, t = toxicity.fit_ordinal(rows, grades, 4)
    assert (np.diff(t) > 0).all()
    eta = np.array([sum(w[f] for f in r) for r in rows])
    assert (np.diff(eta[::30]) > 0).all()
    assert ((eta[:, None] > t).sum(axis=1) == grades).mean() > 0.9


def test_toxicity_learns_and_filters(spark):
    rude = ["idiotlike", "scumbag", "losers"]
    rows = [(i, good() + (" " + " ".join(RNG.sample(rude, 1 + i % 3)) if i % 5 == 0 else "")) for i in range(240)]
    rows += [(9001, None), (9002, ""), (None, "scumbag losers idiotlike"), (0, rows[0][1])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.p1 >= r.p2 >= r.p3 and abs(r.expected_severity - r.p1 - r.p2 - r.p3) < 1e-9
        if r.doc_id is None or r.doc_id < 9000:
            assert r.toxic == (r.doc_id is None or r.doc_id % 5 == 0)
        else:
            assert not r.toxic
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not r.toxic for r in got)


def test_without_labels_or_rows(spark):
    docs, labels = table(spark, 8)
    none = labels.limit(0)
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert {r.toxic for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {False}
    one_kind = labels.where(F.col("quality") == 1)
    assert {r.score for r in quality.score(docs, quality.fit(docs, one_kind)).collect()} == {1.0}
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, labels)).collect() == []
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []


def test_long_chains_in_blocks_equal_the_loop():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 10, 97, 1000):
        e, trans = rng.normal(size=n) * 4, rng.normal(size=(2, 2))
        assert np.allclose(quality.chain_marginals(e, trans), quality.marginals(e, np.array([n]), trans)[0])


def plain_score(model, text):
    """A document's score by enumerating all label paths of its lines."""
    steps, size, n = quality.measure([text])
    x = quality.features(steps, n)
    e = [float(np.clip(v, -30, 30)) for v in x.astype(float) @ model.weights.astype(float)]
    total, mass = 0.0, np.zeros(len(e))
    for path in itertools.product((0, 1), repeat=len(e)):
        s = np.exp(sum(v for v, k in zip(e, path) if k) + sum(model.transitions[a, b] for a, b in zip(path, path[1:])))
        total += s
        mass += s * np.array(path)
    return float((mass / total) @ (size + 1) / (size + 1).sum())


def test_the_quality_query_equals_enumeration(spark, tmp_path):
    from voxloom.llm import queries

    docs, labels = table(spark, 160)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op7_quality(spark, str(tmp_path)).collect()
    model = quality.fit(docs, labels, allowed=remainder("doc_id", 3) != 1)
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(plain_score(model, r.text or ""))
    for i, scores in want.items():
        have = sorted(r.score for r in got if r.doc_id == i)
        assert np.allclose(have, sorted(scores), atol=1e-5)
    assert {r.doc_id for r in got if r.held_out} == {i for i in want if i is not None and zlib.crc32(str(i).encode()) % 3 == 1}


def test_latent_lines_part_a_document_of_two_halves():
    """Bad documents that are half good: their good lines are told from the bad ones, and labels may differ along a chain."""
    texts, labels = [], []
    for i in range(240):
        junk = " | ".join(RNG.choice(WORDS) for _ in range(30))
        texts.append("\n".join([good().split("\n")[0] for _ in range(3)] + ([junk] * 5 if i % 2 == 0 else [good().split("\n")[0] for _ in range(3)])))
        labels.append(i % 2)
    steps, size, n = quality.measure(texts)
    model = quality.fit_chain(quality.features(steps, n), n, np.array(labels), size + 1.0)
    p = quality.line_probabilities(model, steps, n)
    starts = np.cumsum(n) - n
    halves = np.array([[p[a], p[a + k - 1]] for a, k, y in zip(starts, n, labels) if not y])
    assert halves[:, 1].max() < 0.2 and halves[:, 0].mean() > halves[:, 1].mean() + 0.2
    scores = quality.document_scores(model, texts)
    assert ((scores >= 0.5) == np.array(labels)).mean() > 0.97


def test_very_long_texts_are_scored_whole():
    model = quality.ChainModel(np.random.default_rng(1).normal(size=quality.N_FEATURES).astype("f4"), np.array([[0.5, -0.5], [-0.5, 0.5]]))
    text = "\n".join(["a b", "", "###"] * 70_000)
    began = time.perf_counter()
    s, t = quality.document_scores(model, [text, text + "\nlast"])
    assert 0 <= s <= 1 and 0 <= t <= 1 and time.perf_counter() - began < 30
    assert toxicity.words("x " * 300_000 + "rude") == {"x", "rude"}


def test_one_row_a_key_and_bounded_lines(spark):
    from voxloom.llm import labelled

    docs = spark.createDataFrame([(1, f"text {i}\nmore") for i in range(50)] + [(2, "a\nb\nc"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    sample = labelled.labelled_sample(docs, labels, "quality", 10)
    assert sorted((r.doc_id, r.label) for r in sample.collect()) == [(1, 1), (2, 0), (3, 1)]
    lines = F.regexp_count("text", F.lit("\n")) + 1
    assert labelled.within(sample, lines, 6, share=1).count() == 3 and labelled.within(sample, lines, 5, share=1).count() == 2


def test_huge_rows_neither_fill_a_sample_nor_end_it(spark):
    from voxloom.llm import labelled

    size = F.col("size")
    table = lambda rows: spark.createDataFrame([(i, int(y), n) for i, (y, n) in enumerate(rows)], "doc_id long, label int, size long")
    kept = lambda rows, most: {r.doc_id for r in labelled.within(table(rows), size, most).collect()}
    small = [(i % 3 == 0, 1 + i % 5) for i in range(60)]
    for huge in (2_001, 150_000, 199_999, 200_001, 10**12):
        for y in (0, 1):
            assert kept([*small, (y, huge)], 200_000) == set(range(60))
    assert kept([(0, 500), (1, 1), (0, 600)], 1000) == {0, 1}  # all of one class are huge: the smallest first
    assert kept([(0, 400), (1, 600), (1, 700)], 1000) == {0, 1}
    assert kept([(0, 1)] * 10 + [(1, 1)] * 150, 110) == set(range(10)) | kept([(0, 1)] * 10 + [(1, 1)] * 150, 110)
    assert len(kept([(0, 1)] * 10 + [(1, 1)] * 150, 110)) == 110  # a class may use what the other leaves
    have = kept([(i % 2, 1) for i in range(1000)], 100)
    assert len([i for i in have if i % 2]) == len([i for i in have if not i % 2]) == 50
    with pytest.raises(ValueError):
        kept([(0, 5000), (1, 1)], 1000)
    assert kept([(1, 3), (1, 4)], 1000) == {0, 1} and kept([], 10) == set()


def test_one_long_labelled_text_leaves_the_fit_alone(spark):
    rows = [(i, good() if i % 2 else bad()) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(62)], "doc_id long, quality int, toxic int")

    def verdicts(more):
        docs = spark.createDataFrame(rows + more, "doc_id long, text string")
        return {r.doc_id: r.predicted for r in quality.score(docs, quality.fit(docs, labels)).collect() if r.doc_id < 60}

    plain = verdicts([])
    assert plain == {i: i % 2 for i in range(60)}
    for n in (150_000, 199_999, 200_001):
        for doc in (60, 61):
            assert verdicts([(doc, "\n" * (n - 1))]) == plain


def test_lines_are_measured_alike_in_blocks(monkeypatch):
    texts = [good(), "", "a\n\nb", bad() * 3, "x" * 500, "\n" * 70]
    whole = quality.measure(texts)
    monkeypatch.setattr(quality, "CHUNK", 40)
    for a, b in zip(whole, quality.measure(texts)):
        assert (a == b).all()
    assert [x.tolist() for x in quality.measure([""])][1:] == [[0.0], [1]]


def test_the_toxicity_query_equals_a_loop(spark, tmp_path):
    """Every row of op4 recomputed from the model's weights, word by word."""
    from voxloom.llm import queries

    rude = ["idiotlike", "scumbag", "losers"]
    rows = [(i, good() + (" " + " ".join(RNG.sample(rude, 1 + i % 3)) if i % 5 == 0 else ""), "s") for i in range(200)] + [(900, None, "s"), (None, "Scumbag", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(0, 200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    want = {}
    for i, t, _ in rows:
        eta = 0.0
        for w in {"".join(g) for k, g in itertools.groupby((t or "").lower(), lambda c: c.isalpha()) if k}:
            eta += sum(model.weights.get(f, 0.0) for f in (w, w[:5] + "-" if len(w) > 5 else "", w[:7] + "-" if len(w) > 7 else ""))
        want[i] = [1 / (1 + np.exp(th - eta)) for th in model.thresholds]
    got = queries.op4_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.allclose([r.p1, r.p2, r.p3], want[r.doc_id]) and np.isclose(r.expected_severity, sum(want[r.doc_id]))
        assert r.grade == sum(p >= 0.5 for p in want[r.doc_id]) and r.toxic == (r.grade > 0)


def test_grades_come_from_models_that_have_not_seen_the_document():
    rng = np.random.default_rng(3)
    rows = [[0, 1] if k % 4 else [0, 1, *(2 + np.arange(1 + k // 4 % 3)).tolist()] for k in range(240)]
    toxic = np.array([int(k % 4 == 0) for k in range(240)])
    fold = rng.integers(0, 2, 240)
    g = toxicity.latent_grades(rows, toxic, fold, 5)
    assert (g[toxic == 0] == 0).all() and set(g[toxic > 0].tolist()) == {1, 2, 3}
    strength = np.array([len(r) for r in rows])
    assert [strength[g == j].mean() for j in (1, 2, 3)] == sorted(strength[g == j].mean() for j in (1, 2, 3))
    other = toxicity.latent_grades(rows, np.where(np.arange(240) == 0, 0, toxic), fold, 5)
    assert (other[(fold == fold[0]) & (toxic > 0) & (np.arange(240) > 0)] > 0).all()
