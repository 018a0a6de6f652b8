"""Base scores against a loop, the model's sums to one, and held-out gain."""

import collections
import math
import random
import zlib

import numpy as np

from pyspark.sql import functions as F

from voxloom.llm import language_model as lm
from voxloom.llm.labelled import remainder

RNG = random.Random(2)


def corpus():
    left, right = [f"aa{i}th" for i in range(30)], [f"bb{i}éz" for i in range(30)]
    rows = []
    for i in range(160):
        words = RNG.choice([left, right])
        rows.append((i, " ".join(RNG.choice(words) for _ in range(RNG.randrange(1, 60)))))
    return rows + [(200, None), (201, ""), (202, " \n "), (203, "The  THE the\tunseen%d" % RNG.randrange(9)), (None, "aa1th aa2th"), (5, rows[5][1])]


def test_base_and_counts(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    toks = [[w for w in (t or "").encode().lower().split()] + [lm.END] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = collections.Counter(w for ws, h in zip(toks, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    for frequent in (500_000, 20):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        got = lm.score_documents(docs, remainder("doc_id", 7) == 2).collect()
        assert len(got) == len(rows)
        want = sorted((-1 if i is None else i, h, len(ws), sum(c[w] > 0 for w in ws), n) for (i, _), ws, h in zip(rows, toks, held))
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
        base = {i: sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) for (i, _), ws in zip(rows, toks)}
        for r in got:
            assert abs(r.base_score - base[r.doc_id]) < 1e-9 * max(1, abs(base[r.doc_id]))
        far = [r for r in got if r.held_out]
        assert far and sum(r.score for r in far) > sum(r.base_score for r in far)


def test_class_probabilities_sum_to_one_and_training_helps():
    of_ending = lm.cluster_endings(np.zeros((lm.N_ENDINGS, lm.N_ENDINGS)))
    coded, starts = lm.encode_texts(["a b c a b c", None, "b c a"], of_ending)
    assert starts.tolist() == [0, 7, 8]
    h = lm.histories(coded, starts)
    assert len(coded) == 12 and h.context[[0, 7, 8]].tolist() == [0, 0, 0]
    w, squares = np.zeros((lm.N_BUCKETS, lm.N_CLASSES), np.float32), np.ones(lm.N_BUCKETS)
    prior = np.zeros(lm.N_CLASSES)
    first = lm.log_softmax(w, lm.class_sums(w, prior), h)
    for _ in range(30):
        lm.gradient_step(w, prior, squares, h)
    last = lm.log_softmax(w, lm.class_sums(w, prior), h)
    assert np.allclose(np.exp(first).sum(axis=1), 1, atol=1e-5) and np.allclose(np.exp(last).sum(axis=1), 1, atol=1e-5)
    at = np.arange(len(h.c))
    assert last[at, h.c].mean() > first[at, h.c].mean() + 1


def test_words_are_those_of_split():
    texts = ["The  the,\tTHE!?  x", "", None, " \n", "é\u00a0ü\u0085 a.", "...", "w" * 3000 + " z", "\x1c b\x0bc\x0cd", "last"]
    raws = [lm.lowered(t) for t in texts]
    h, e, upto = lm.word_codes(raws)
    words = [w for r in raws for w in r.split()]
    assert len(h) == len(e) == len(words) and upto.tolist() == np.cumsum([len(r.split()) for r in raws]).tolist()
    code = {}
    for w, x, y in zip(words, h.tolist(), e.tolist()):
        assert code.setdefault(w, (x, y)) == (x, y)
    assert len({x for x, _ in code.values()}) == len(code)
    assert code[b"the"][1] == code[b"the,"][1] and code[b"the,"][1] != code[b"x"][1]
    assert [len(a) for a in lm.word_codes([])] == [0, 0, 0] and lm.word_codes([b"", b" "])[2].tolist() == [0, 0]
    coded, starts = lm.encode_texts(texts, np.ones(lm.N_ENDINGS, np.int64))
    assert len(coded) == sum(len(lm.tokens(t)) for t in texts)
    assert starts.tolist() == np.cumsum([0] + [len(lm.tokens(t)) for t in texts])[:-1].tolist()
    assert [(coded[b - 1] & np.uint64(15)) for b in [*starts[1:].tolist(), len(coded)]] == [0] * len(texts)


def test_endings_cluster_by_neighbours():
    t = np.zeros((lm.N_ENDINGS, lm.N_ENDINGS))
    groups = [range(0, 10), range(10, 25), range(25, 60)]
    for g in groups:
        for a in g:
            for b in g:
                t[a, b] = 5 + (a * b) % 3
    c = lm.cluster_endings(t)
    assert c.min() >= 1 and c.max() < lm.N_CLASSES and np.array_equal(c, lm.cluster_endings(t))
    seen = [set(c[list(g)].tolist()) for g in groups]
    assert not (seen[0] & seen[1] or seen[0] & seen[2] or seen[1] & seen[2])


def test_empty_and_all_held_out(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_documents(docs, F.lit(False)).collect() == []
    got = lm.score_documents(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(True)).collect()
    assert got[0].n_known == 0 and got[0].train_tokens == 0 and got[0].base_score == 0.0


def loop_scores(rows, held, of_ending, weights, total, n_buckets):
    """log10 probability of every text by plain loops over tokens, classes and outputs."""
    count = collections.Counter(w for (_, t), h in zip(rows, held) if not h for w in lm.tokens(t))
    tables, priors = (weights[:n_buckets], weights[n_buckets:]), (total.prior(), total.within())

    def code(word):
        if word == lm.END:
            return 0
        h, e, _ = lm.word_codes([word])
        return int(h[0]) & ~15 | int(of_ending[e[0]])

    def row(table, key, kind):
        return tables[table][int(lm._bucket(np.array([key], np.uint64), kind, n_buckets)[0])].astype(float)

    out = []
    for _, t in rows:
        codes, score = [code(w) for w in lm.tokens(t)], 0.0
        for k, word in enumerate(lm.tokens(t)):
            side = [codes[k - b] % 16 + 1 if k >= b else 0 for b in (1, 2, 3)]
            last, second = (codes[k - b] if k >= b else 0 for b in (1, 2))
            n = lm.N_CLASSES + 1
            z = priors[0].astype(float)
            for kind, key in enumerate((side[0], side[0] * n + side[1], (side[0] * n + side[1]) * n + side[2], side[1], side[0] * n + side[2]), 1):
                z = z + row(0, key, kind)
            z = z + row(0, last, 6) + row(0, (last * lm._BASE + second) % (1 << 64), 7)
            c, o = codes[k] % 16, (codes[k] >> 8) % lm.N_OUTPUTS
            y = priors[1][c].astype(float) + row(1, last ^ c, 8) + row(1, second ^ c, 9)
            p = np.exp(z[c]) / np.exp(z).sum() * np.exp(y[o]) / np.exp(y).sum()
            score += math.log10(p * (count[word] + 1) / (total.n_output[c, o] + total.v_output[c, o] + 1))
        out.append(score)
    return out


def test_the_whole_query_equals_a_loop(spark, tmp_path, monkeypatch):
    from voxloom.llm import queries

    rows = corpus()
    spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    train, cluster, table = lm.train_weights, lm.ending_classes, lm._class_table
    monkeypatch.setattr(lm, "train_weights", lambda *a: seen.setdefault("weights", train(*a)))
    monkeypatch.setattr(lm, "ending_classes", lambda t: seen.setdefault("of_ending", cluster(t)))
    monkeypatch.setattr(lm, "_class_table", lambda *a: seen.setdefault("total", table(*a)))
    got = queries.op10_language_model(spark, str(tmp_path)).collect()
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    want = sorted((-1 if i is None else i, s) for (i, _), s in zip(rows, loop_scores(rows, held, seen["of_ending"], seen["weights"], seen["total"], lm.N_BUCKETS)))
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in got)
    assert [i for i, _ in have] == [i for i, _ in want]
    assert np.allclose([s for _, s in have], [s for _, s in want], rtol=1e-4, atol=1e-3)


def test_probabilities_of_all_words_sum_to_one():
    """Over classes, outputs and the words behind each output, with the share of words never seen."""
    rng = np.random.default_rng(5)
    n_output = rng.integers(0, 50, (lm.N_CLASSES, lm.N_OUTPUTS))
    v_output = np.minimum(n_output, rng.integers(1, 9, n_output.shape))
    total = lm.Counts(int(n_output.sum()), int(v_output.sum()), n_output, v_output)
    of_ending = lm.cluster_endings(np.zeros((lm.N_ENDINGS, lm.N_ENDINGS)))
    h = lm.histories(*lm.encode_texts(["a b c a b c", None, "b c a"], of_ending))
    w, v = (rng.normal(size=(lm.N_BUCKETS, lm.N_CLASSES)).astype("f4") for _ in range(2))
    p = np.exp(lm.log_softmax(w, lm.class_sums(w, total.prior()), h))
    words = (n_output + v_output + 1.0) / (n_output + v_output + 1.0)  # seen words and the share of the unseen
    for c in range(lm.N_CLASSES):
        h.c[:] = c
        y = np.exp(lm.output_scores(v, total.within(), h))
        p[:, c] *= (y / y.sum(axis=1, keepdims=True)) @ words[c]
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_training_moves_words_within_a_class():
    """Two words of one class that follow different words: the history tells them apart."""
    rng = random.Random(1)
    of_ending = np.ones(lm.N_ENDINGS, np.int64)
    by_output = {}
    for word in "red blue apple sky tree house river stone cloud".split():
        by_output.setdefault(int(lm.outputs(lm.word_codes([word.encode()])[0])[0]), word)
    a, b, c, d = list(by_output.values())[:4]  # words with outputs of their own
    texts = [" ".join(rng.choice([f"{a} {b}", f"{c} {d}"]) for _ in range(40)) for _ in range(30)]
    coded, starts = lm.encode_texts(texts, of_ending)
    h = lm.histories(coded, starts)
    prior = np.zeros((lm.N_CLASSES, lm.N_OUTPUTS), np.float32)
    w, squares = np.zeros((lm.N_BUCKETS, lm.N_OUTPUTS), np.float32), np.ones(lm.N_BUCKETS)
    for _ in range(60):
        lm.output_step(w, prior, squares, h)
    y = np.exp(lm.output_scores(w, prior, h))
    p = (y / y.sum(axis=1, keepdims=True))[np.arange(len(coded)), h.output]
    follows = np.isin(np.arange(len(coded)) - np.repeat(starts, np.diff(np.append(starts, len(coded)))), range(1, 80, 2))
    assert p[follows].mean() > 0.8


def test_table_grows_with_the_corpus():
    sizes = [lm.buckets_for(n) for n in (0, 1 << 28, (1 << 28) + 1, 1 << 30, 1 << 32, 1 << 50)]
    assert sizes == [1 << 14, 1 << 14, 1 << 15, 1 << 15, 1 << 16, 1 << 18]
    h = lm.histories(*lm.encode_texts(["a b c"], np.ones(lm.N_ENDINGS, np.int64)), 1 << 16)
    assert max(h.last.max(), h.pair.max(), h.near.max(), h.skip.max()) < 1 << 16
    w = np.zeros((1 << 17, lm.N_CLASSES), np.float32)
    lm.gradient_step(w, np.zeros(lm.N_CLASSES), np.ones(1 << 17), lm.histories(*lm.encode_texts(["a b c"], np.ones(lm.N_ENDINGS, np.int64)), 1 << 17))
    assert w.any()
