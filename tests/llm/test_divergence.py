"""Audit of sources against a loop with Python's integers; tiles and heaps of several blocks and groups."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from voxloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, rank string, value string, part int"


def loop(rows, least, top=50, scale=10**9):
    counts, df, groups = defaultdict(Counter), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        df.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (own, t), n in df.items() if own == lang and n >= least]
        mine = [s for own, s in groups if own == lang]

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + scale * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in mine}
        q = shares(sum((counts[lang, s] for s in mine), Counter()))
        for s in mine:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in mine if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, have in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(have, 1)]
    return sorted(out)


def rows():
    rng = random.Random(5)
    words = [f"w{chr(97 + i)}{chr(97 + i * 7 % 26)}" for i in range(26)] + ["Éa", "日本", "THE", "don't", "a1b", "x_y", " z"]
    out = []
    for i in range(300):
        source = rng.choice(["hot"] * 6 + ["a", "b", "c", None])
        text = rng.choice([" ", "-", "\x00"]).join(rng.choice(words[: 20 + 13 * (source == "a")]) for _ in range(rng.randrange(30)))
        out.append((i, text, rng.choice(["en", "en", "de", None]), source, "x", "y", 1))
    out += [(7, "THE same twice", "en", "hot", "x", "y", 1)] * 40
    return out + [(None, None, "en", "void", "x", "y", 1), (1, "12 34", "zz", "s1", "x", "y", 1), (1, "rare", "zz", "s2", "x", "y", 1), (2, "", "lone", "only", "x", "y", 1)]


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("least,more", [(30, {}), (1, {"top": 3}), (5, {"block_terms": 3, "group_sources": 2}), (2, {"block_terms": 1, "group_sources": 1})])
def test_audit_equals_a_loop(spark, least, more):
    have = rows()
    df = divergence.audit(spark.createDataFrame(have, SCHEMA).repartition(4), least_docs=least, **more)
    assert dict(df.dtypes)["value"] == "bigint" and dict(df.dtypes)["rank"] == "int"
    assert got(df) == loop(have, least, more.get("top", 50))


def test_one_long_text(spark):
    rng = random.Random(9)
    have = [(i, " ".join(rng.choice("abcdef") * 3 for _ in range(n)), "en", s, "x", "y", 1) for i, (n, s) in enumerate([(150_000, "a"), (10, "a"), (10, "b")])]
    assert got(divergence.audit(spark.createDataFrame(have, SCHEMA), least_docs=1)) == loop(have, 1)


def test_pair_sums_in_parts(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 40, (7, 11)), rng.integers(0, 1 << 40, (5, 11))
    monkeypatch.setattr(divergence, "CELLS", 60)
    assert (divergence.pair_sums(a, b) == [[sum(abs(int(x) - int(y)) for x, y in zip(r, s)) for s in b] for r in a]).all()


def test_empty(spark):
    assert got(divergence.audit(spark.createDataFrame([], SCHEMA))) == []


def test_texts_are_cut_into_terms_once(spark, monkeypatch):
    have = spark.createDataFrame(rows(), SCHEMA)
    scans, frame = [], type(have)
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, f=frame.mapInArrow, **b: scans.append(self.columns) or f(self, *a, **b))
    divergence.audit(have, least_docs=5)
    assert scans == [["lang", "source", "text"]]
