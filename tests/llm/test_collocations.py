"""Phrases against a loop over every occurrence."""

import random
import re
from collections import Counter

from voxloom.llm import collocations

SCHEMA = "doc_id long, text string, lang string, rank string, phrase int, n int"


def loop(rows, least, top, most=5):
    f, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for n in range(1, most + 1):
                f.update((lang, tuple(ws[i : i + n])) for i in range(len(ws) - n + 1))
    big = {k: v for k, v in f.items() if v >= least}
    out = []
    for lang in {k[0] for k in big}:
        have = []
        for (own, p), a in big.items():
            if own != lang or len(p) < 2:
                continue
            score, k = min((1000 * a * total[lang] // (big[lang, p[:k]] * big[lang, p[k:]]), k) for k in range(1, len(p)))
            inside = any(o == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for (o, q), b in big.items())
            if not inside:
                have.append((-score, -a, " ".join(p).encode(), big[lang, p[:k]], big[lang, p[k:]], total[lang]))
        for rank, (s, a, p, left, right, n) in enumerate(sorted(have)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def rows():
    rng = random.Random(3)
    words = ["new", "york", "City", "los", "angeles", "é", "日本", "a", "the", "x\x0by", " ", "b\x00c", "\x1cq"]
    out = []
    for i in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\t ", ", ", "\n", "  ", ". "]) for _ in range(rng.randrange(40)))
        out.append((i, text + "In the Heart of darkness and more. a a a a", rng.choice(["en", "en", "de", None, "und"]), "x", 1, 2))
    return out + [(1, None, "en", "x", 1, 2), (None, "", None, "x", 1, 2), (2, " . ! ", "xx", "x", 1, 2)] + [(7, "hot phrase here", "en", "x", 1, 2)] * 300


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def test_phrases_equal_a_loop(spark):
    have = rows()
    for least, top in ((100, 2000), (20, 7), (3, 40)):
        assert got(collocations.collocations(spark.createDataFrame(have, SCHEMA).repartition(5), least=least, top=top)) == loop(have, least, top)


def test_one_long_text_and_small_groups(spark, monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh") + rng.choice([" ", " ", " ", ". "]) for _ in range(60_000))
    have = [(1, text, "en", "x", 1, 2), (2, text[:5000], "en", "x", 1, 2)]
    monkeypatch.setattr("voxloom.llm.words.SLICE", 1000)
    assert got(collocations.collocations(spark.createDataFrame(have, SCHEMA), least=30)) == loop(have, 30, 2000)


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    counted = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 7)], "lang string, phrase string, size int, n long")
    totals = spark.createDataFrame([("en", 900 * big)], "lang string, total long")
    r = collocations.score_phrases(counted, totals).first()
    assert r.score == 1000 * (big - 7) * 900 * big // (big * (big + 1)) and (r.l, r.r) == (big, big + 1)


def test_empty(spark):
    assert got(collocations.collocations(spark.createDataFrame([], SCHEMA))) == []


def test_sums_over_batches_in_bounded_memory():
    import pyarrow as pa

    from voxloom.llm import words

    rng = random.Random(4)
    rows = [(rng.choice("ab"), f"p{rng.randrange(rng.choice([5, 500]))}", rng.randrange(9)) for _ in range(4000)]
    want = Counter()
    for lang, p, n in rows:
        want[lang, p] += n
    for most in (8, 64, 100_000):
        batches = [pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows[a : a + 37]))), ["lang", "phrase", "n"]) for a in range(0, len(rows), 37)]
        got, biggest = Counter(), 0
        for b in words.summed(iter(batches), "n", most):
            assert b.schema.names == ["lang", "phrase", "n"]
            biggest = max(biggest, b.num_rows)
            for r in b.to_pylist():
                got[r["lang"], r["phrase"]] += r["n"]
        assert got == want and biggest <= max(most // 8, 1)
    assert list(words.summed(iter([]), "n")) == []


def test_words_in_slices_are_the_words_of_the_whole(monkeypatch):
    from voxloom.llm import words

    rng = random.Random(5)
    raws = ["".join(rng.choice("ab  \n\té") for _ in range(n)).encode() for n in (0, 1, 300, 5000)]
    whole = words.coded(raws)
    for size in (3, 50):
        monkeypatch.setattr(words, "SLICE", size)
        d, ids, sizes = words.coded(raws)
        assert [d[i].as_py() for i in ids.tolist()] == [w for r in raws for w in r.split()] == [whole[0][i].as_py() for i in whole[1].tolist()]
        assert sizes.tolist() == [len(r.split()) for r in raws] == whole[2].tolist()
