"""Leak search against brute force, and the aligner against a plain table."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import decontamination as dc
from voxloom.llm.alignment import banded
from voxloom.llm.passages import fold

RNG = random.Random(11)
WORDS = ["the", "hation", "ou", "éaux", "thinger", "of", "rest", "blehe", "onwh", "edth"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "ing"]) for _ in range(n))


def plain_best(p, t):
    """Least edits of p anywhere in t."""
    row = [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        new = [i]
        for j in range(1, len(t) + 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p[i - 1] != t[j - 1])))
        row = new
    return min(row)


def edit(t, n, rng=RNG):
    for _ in range(n):
        i = rng.randrange(len(t))
        t = rng.choice([t[:i] + t[i + 1 :], t[:i] + "x" + t[i:], t[:i] + "q" + t[i + 1 :]])
    return t


def test_banded_equals_the_full_table_where_the_band_covers_it():
    for _ in range(60):
        p = prose(4)[:30]
        t = prose(1)[:5] + edit(p, RNG.randrange(5)) + prose(1)[:5]
        (edits, start, end), = banded([fold(p)], [fold(t)], len(t))
        assert edits == plain_best(p, t)
        assert 0 <= start <= end <= len(t)
        assert plain_best(p, t[start:end]) == edits


def test_scanner_equals_brute_force():
    items = [prose(30), prose(12), prose(6)]
    windows = [w for i, t in enumerate(items) for w in dc.cut_windows(i, t, dc.WINDOW, dc.RATE, dc.Q)]
    scanner = dc.Scanner(windows)
    for trial in range(60):
        core = RNG.choice(items)
        cut = RNG.randrange(len(core) // 2) if trial % 3 == 0 else 0
        text = prose(RNG.randrange(40)) + " " + edit(core[cut:], RNG.randrange(12)) + " " + prose(RNG.randrange(40))
        got = {w for w, *_ in scanner(text)}
        folded = "".join(map(chr, fold(text)))
        want = {i for i, w in enumerate(windows) if plain_best("".join(map(chr, w.cp)), folded) <= w.edits}
        assert got == want
        for w, _, a, b in scanner(text):
            assert plain_best("".join(map(chr, windows[w].cp)), folded[a:b]) <= windows[w].edits


def test_quotations_from_every_offset(spark):
    """Exact quotations of the least length are found wherever in the item they begin; so is a run of 13 words."""
    rng = random.Random(23)
    least = dc.WINDOW + dc.STRIDE - 1
    assert least == 51
    text = " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(2, 9))) for _ in range(120))
    lead, tail = prose(20, rng), prose(20, rng)
    for size in (60, 97, 160, 233, 290, 394):
        item = text[:size].strip()
        docs, bench = [(0, lead + tail)], [(5, item)]
        for at in range(len(item) - least + 1):
            docs.append((1 + at, f"{lead} {item[at : at + least]} {tail}"))
        if size == 394:
            words = item.split()
            docs += [(1000 + k, f"{lead} {' '.join(words[k : k + 13])} {tail}") for k in range(len(words) - 12)]
        docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
        assert [r.doc_id for r in dc.drop_leaks(docs, bench).collect()] == [0]


def test_leaks_and_filter(spark, monkeypatch):
    rng = random.Random(31)  # of its own, so that what other tests draw doesn't matter
    items = [prose(40, rng), prose(14, rng), None, "", "tiny"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    leaky = prose(50, rng) + " " + items[0].upper().replace(" ", "\n") + " " + prose(20, rng)
    quote = prose(30, rng) + " " + " ".join(items[0].split()[:6]) + " " + prose(30, rng)
    rows = [(1, prose(300, rng), "z"), (2, leaky, "z"), (3, quote, "z"), (4, None, "z"), (5, "", "z"), (6, edit(items[1], 5, rng), None), (None, items[1], "z"), (2, leaky, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    for size in (1 << 21, 10):
        monkeypatch.setattr(dc, "blocks", lambda b, i="item_id", f=dc.blocks, s=size: f(b, i, size=s))
        got = sorted((r.doc_id or 0, r.item_id) for r in dc.find_leaks(docs, bench).collect())
        assert got == [(0, 1), (2, 0), (2, 0), (6, 1)]
        kept = dc.drop_leaks(docs, bench)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
        monkeypatch.undo()
    assert dc.find_leaks(docs.limit(0), bench).collect() == [] and dc.find_leaks(docs, bench.limit(0)).collect() == []


def test_long_texts_are_scanned_in_spans(monkeypatch):
    monkeypatch.setattr(dc, "SPAN", 700)
    item = prose(30)
    scanner = dc.Scanner(dc.cut_windows(0, item, dc.WINDOW, dc.RATE, dc.Q))
    for lead in (0, 300, 505, 610, 2000):
        text = (prose(1000)[:lead]) + item + prose(200)
        assert {w for w, *_ in scanner(text)} == set(range(len(scanner.windows)))


def test_bound_of_the_lemma():
    for w in dc.cut_windows(0, prose(60), dc.WINDOW, dc.RATE, dc.Q):
        assert w.least == len(w.cp) + 1 - dc.Q * (w.edits + 1) > 0
    assert np.array_equal(fold("A\tÉ\nİ"), [ord("a"), 32, ord("é"), 32, ord("İ")])


def test_ids_of_other_types(spark):
    rng = random.Random(4)
    items = [prose(40, rng) for _ in range(2)]
    texts = [*(prose(60, rng) for _ in range(5)), items[1], *(prose(60, rng) for _ in range(3)), items[0]]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # the first batches of a task find nothing
    try:
        for kind in ("string", "int"):
            bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string").withColumn("item_id", F.col("item_id").cast(kind))
            docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("doc_id", F.col("doc_id").cast(kind)).coalesce(1)
            got = dc.find_leaks(docs, bench)
            assert got.schema["item_id"].dataType.simpleString() == kind
            assert sorted((int(r.doc_id), int(r.item_id)) for r in got.collect()) == [(5, 1), (9, 0)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_repetitive_texts_stay_small():
    """Items that share a run of blanks against a million blanks: few matches, little memory."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    items = [" ".join(word() for _ in range(8)) + " " * 10 + " ".join(word() for _ in range(8)) for _ in range(3000)]
    scanner = dc.Scanner([w for i, t in enumerate(items) for w in dc.cut_windows(i, t, dc.WINDOW, dc.RATE, dc.Q, dc.STRIDE)])
    tracemalloc.start()
    try:
        assert scanner(" " * 1_000_000) == []
        assert {scanner.windows[w].item for w, *_ in scanner((items[7] + "   ") * 2_000)} >= {7}
        assert tracemalloc.get_traced_memory()[1] < 1 << 29
    finally:
        tracemalloc.stop()


def test_repetitive_texts_equal_brute_force():
    rng = random.Random(5)
    items = ["a" + " " * 70 + "b", "ab" * 40, "the end" + " " * 10 + "of the line and more of it here", "-" * 60, "x" * 20 + "y" * 30 + "x" * 20]
    windows = [w for i, t in enumerate(items) for w in dc.cut_windows(i, t, dc.WINDOW, dc.RATE, dc.Q, dc.STRIDE)]
    scanner = dc.Scanner(windows)
    texts = [" " * 900, "ab" * 500, "-" * 700 + "z", ("the end" + " " * 12 + "of the\n") * 20, "x" * 300 + "y" * 31 + "x" * 300, "aab" * 200, edit(items[4] * 9, 40, rng), edit(items[0] * 9, 30, rng)]
    for text in texts:
        folded = "".join(map(chr, fold(text)))
        want = {i: e for i, w in enumerate(windows) if (e := plain_best("".join(map(chr, w.cp)), folded)) <= w.edits}
        assert {w: e for w, e, *_ in scanner(text)} == want
        assert bool(scanner(text, any_=True)) == bool(want)


def test_a_long_item_is_spread_over_blocks(spark, monkeypatch):
    rng = random.Random(9)
    item = "  " + prose(400, rng) + "\u3000"
    bench = spark.createDataFrame([(1, item), (2, prose(9, rng))], "item_id long, text string")
    whole = [(w.item, w.start, w.cp.tobytes()) for w in dc.cut_windows(1, item, dc.WINDOW, dc.RATE, dc.Q, dc.STRIDE)]
    monkeypatch.setattr(dc, "PIECE", 200)
    for size in (1 << 19, 500):
        got = [b for b in dc.blocks(bench, size=size)]
        assert len(got) == (1 if size > 500 else len(got)) and (size > 500 or len(got) > 3)
        assert {(w.item, w.start, w.cp.tobytes()) for b in got for w in b if w.item == 1} == set(whole)


@pytest.mark.parametrize("per_pass", [1, 2, 50])
def test_one_row_for_an_item_of_many_blocks_and_texts(spark, monkeypatch, per_pass):
    rng = random.Random(11)
    long = prose(400, rng)
    items = [(1, long), (2, prose(30, rng)), (1, prose(40, rng)), (3, prose(30, rng)), (3, None), (2, ""), (4, prose(60, rng))]
    items += [items[1], (None, prose(30, rng))]
    texts = [long, "x " + long[700:900] + " y", items[1][1] + " " + items[2][1], items[3][1] + items[8][1], prose(50, rng), None, "", long[:300] + items[6][1]]
    docs = spark.createDataFrame([(i % 6, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s")], "doc_id long, text string, source string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = lambda df: sorted(map(str, df.collect()))
    want = plain(dc.find_leaks(docs, bench))
    kept = plain(dc.drop_leaks(docs, bench))
    pairs = [w.split("n_windows")[0] for w in want]
    assert len(pairs) == 9 and pairs.count("Row(doc_id=0, item_id=1, ") == 2  # of two rows alike; every other pair once
    monkeypatch.setattr(dc, "PIECE", 200)
    monkeypatch.setattr(dc, "BLOCKS", per_pass)
    monkeypatch.setattr(dc, "blocks", lambda b, i, f=dc.blocks: f(b, i, size=500))
    assert len(list(dc.blocks(bench, "item_id"))) > 4
    assert plain(dc.find_leaks(docs, bench)) == want
    assert plain(dc.drop_leaks(docs, bench)) == kept and len(kept) == 3


def test_blocks_share_passes(spark, monkeypatch):
    rng = random.Random(12)
    bench = spark.createDataFrame([(i, prose(20, rng)) for i in range(60)], "item_id long, text string")
    monkeypatch.setattr(dc, "blocks", lambda b, i, f=dc.blocks: f(b, i, size=300))
    sizes = [len(p) for p in dc.passes(bench)]
    assert sum(sizes) == len(list(dc.blocks(bench, "item_id"))) and max(sizes) <= dc.BLOCKS + 2 and len(sizes) <= sum(sizes) / dc.BLOCKS + 1


def test_the_whole_query_equals_brute_force(spark, tmp_path):
    """op2 over small tables against the full edit table of every window and document."""
    from voxloom.llm import queries

    rng = random.Random(17)
    items = [prose(n, rng) for n in (20, 9, 13)] + [None]
    texts = []
    for k in range(24):
        core = rng.choice(items[:3])
        text = prose(rng.randrange(9), rng) + " " + (edit(core[rng.randrange(40) :], rng.randrange(9), rng) if k % 2 else "") + " " + prose(rng.randrange(9), rng)
        texts.append(text)
    texts += [None, "", texts[1]]
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {}
    for i, t in enumerate(texts):
        folded = "".join(map(chr, fold(t or "")))
        for j, item in enumerate(items):
            found = [plain_best("".join(map(chr, w.cp)), folded) <= w.edits for w in dc.cut_windows(j, item or "", dc.WINDOW, dc.RATE, dc.Q, dc.STRIDE)]
            if any(found):
                want[i, j] = sum(found)
    got = {(r.doc_id, r.item_id): r.n_windows for r in queries.op2_decontamination(spark, str(tmp_path)).collect()}
    assert got == want and want
