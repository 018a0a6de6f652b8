"""The pipeline on a small corpus, stage by stage against plain versions of the decisions."""

import random

import pytest

P = pytest.importorskip("public_tokenizers")
pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_classifiers import WORDS, bad  # noqa: E402
from voxloom.llm import sketches  # noqa: E402

RNG = random.Random(12)


def good(n=None):
    words = [f"{RNG.choice(WORDS)}{RNG.choice(WORDS)}{RNG.randrange(9)}" for _ in range(n or RNG.randrange(60, 120))]
    return "\n".join(" ".join(words[i : i + 12]) + "." for i in range(0, len(words), 12))


def test_run_equals_plain_decisions(spark, tmp_path):
    items = [good(30) for _ in range(3)]
    rows, labels, want = [], [], {}
    for i in range(300):
        text, keep = good(), True
        if i % 6 == 0:
            text, keep = bad(), False
        elif i % 7 == 0:
            text, keep = text + " scumbag losers idiotlike scum", False
        elif i % 11 == 0:
            text, keep = text + "\n" + RNG.choice(items), False
        rows.append((i, text, "en", "src", len(text)))
        labels.append((i, int(i % 6 != 0), int(i % 6 != 0 and i % 7 == 0)))
        if keep:
            want[i] = text
    for i, of in ((400, 1), (401, 2), (402, 1)):  # copies with one word more
        rows.append((i, rows[of][1] + " more", "en", "src", 0))
    for i, of in ((500, 3), (501, 4)):
        rows.append((i, rows[of][1], "en", "src", 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    memo = sketches.WordHashes()
    a, b = (set(sketches.shingles(t, memo).tolist()) for t in (rows[1][1], rows[1][1] + " more"))
    assert 100 * len(a & b) >= 85 * len(a | b)

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in want.items()}


def test_order_of_stages():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "toxicity", "near_dup", "decontamination", "bpe"] and pipeline.ORACLE_SQL is None


def test_odd_rows_and_empty_tables(spark, tmp_path):
    """Null ids and texts, repeated rows, long texts, further columns with clashing names, and no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, label int, cell string"
    texts = [good() for _ in range(40)]
    rows = [(i, t, "en", "s", len(t), "x", 1, "y") for i, t in enumerate(texts)]
    rows += [(None, good(), None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (70, None, "en", "s", 0, "x", 1, "y"), (71, "", "en", "s", 0, "x", 1, "y")]
    rows += [rows[3], rows[3], (72, " \n ", "en", "s", 3, "x", 1, "y"), (73, good(9000), "en", "s", 0, "x", 1, "y")]
    labels = [(i, 1, 0) for i in range(40)]
    for name, n in (("full", None), ("empty", 0)):
        folder = tmp_path / name
        spark.createDataFrame(rows[:n], schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels[:n], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, good(30))][:n], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, f in pipeline.STAGES[:-1]:
            docs = f(spark, docs, str(folder))
            assert docs.columns == [c.split()[0] for c in schema.split(", ")], stage
        got = pipeline.run(spark, str(folder)).collect()
        if n == 0:
            assert got == []
            continue
        ids = [r.doc_id for r in got]
        assert ids.count(3) == 1 and set(range(40)) <= set(ids) and {70, 71, 72, 73} <= set(ids) and ids.count(None) == 2
        for r in got:
            assert len(r.ids) == r.n_tokens and (r.n_tokens > 0) == (r.doc_id not in (70, 71) and (r.doc_id is not None or r.n_tokens > 0))
