"""License scans against brute force over every place."""

import random

import numpy as np

from tests.llm.test_passages import edit, plain_best, prose
from voxloom.llm import licenses as li
from voxloom.llm.passages import fold, short_hashes

RNG = random.Random(8)


def test_exact_and_edited_notices(spark):
    rows, want = [], []
    for i, (name, t) in enumerate(li.TEMPLATES.items()):
        rows.append((i, f"{prose(40)}\n{t.upper()}.\n{prose(30)}", "x"))
        want.append((i, *name.split("/")))
        head = t[: 2 * len(t) // 3]
        rows.append((100 + i, f"{prose(5)} {head}{t[len(head) + 1:]} {prose(9)} {t}", "x"))
        want.append((100 + i, *name.split("/")))
    rows += [(900, prose(2000), "x"), (901, None, "x"), (902, "", "x"), (None, "Licensed under CC BY-NC 4.0.", "x"), (903, "licensed under the", "x")]
    want.append((None, "CC-BY-NC-4.0", "notice"))
    got = li.find_licenses(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect()
    found = {(r.doc_id, r.license, r.form) for r in got}
    assert set(want) <= found
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        t = li.TEMPLATES[f"{r.license}/{r.form}"]
        assert li.COVERAGE <= r.coverage <= 1
        for s in r.spans:
            assert 0 <= s.start < s.end <= len(texts[r.doc_id])
        if r.doc_id is not None and r.doc_id < 100 and (r.doc_id, r.license, r.form) in want:
            assert r.coverage == 1 and texts[r.doc_id][r.spans[0].start : r.spans[0].end].upper() == t.upper()
        if (r.doc_id, r.license, r.form) not in want:  # a header begins with its notice
            whole = li.TEMPLATES[f"{r.license}/header"]
            assert r.form == "notice" and plain_best(t.lower(), whole.lower()) <= len(t) // 10
    assert not {900, 901, 902, 903} & {r.doc_id for r in got}
    assert li.find_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_window_is_found_where_a_long_enough_stretch_is_shared():
    scanner = li.LicenseScanner({"a/b": prose(9), "c/d": prose(30)})
    for _ in range(80):
        w = RNG.choice(scanner.windows)
        text = prose(20) + " " + edit("".join(map(chr, w.cp)), RNG.randrange(4)) + " " + prose(20)
        got = {k for k, *_ in scanner._span(fold(text))}
        for k, v in enumerate(scanner.windows):
            if plain_best("".join(map(chr, v.cp)), text) <= min(v.edits, 3):
                assert k in got
            elif k in got:
                assert plain_best("".join(map(chr, v.cp)), text) <= v.edits


def test_winnowing_takes_the_least_of_every_run():
    for n in (1, 3, 4, 5, 60):
        h = short_hashes(fold(prose(40)), 8)[:n]
        at = li.winnow(h, 4)
        for i in range(max(1, len(h) - 3)):
            run = h[i : i + 4]
            assert any(i <= a < i + 4 and h[a] == run.min() for a in at)
        assert len(np.unique(at)) == len(at)


def test_versions_and_variants_are_told_apart():
    scanner, rng = li.LicenseScanner(li.TEMPLATES), random.Random(6)
    for name, t in li.TEMPLATES.items():
        for text in (t, f"{prose(20, rng)} {t}; {prose(20, rng)}"):
            licenses = {n.split("/")[0] for n, *_ in scanner(text)}
            assert licenses == {name.split("/")[0]}, name
    two = f"{li.TEMPLATES['GPL-2.0/notice']}. {prose(40, rng)} {li.TEMPLATES['GPL-3.0/notice']}."
    assert {n for n, *_ in scanner(two)} == {"GPL-2.0/notice", "GPL-3.0/notice"}


def test_long_templates_and_repetitive_texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    body = " ".join(word() for _ in range(3000))
    rule = "-" * 40
    scanner = li.LicenseScanner({"long/text": body, **{f"ruled{i}/text": f"{prose(9, rng)} {rule} {prose(9, rng)}" for i in range(50)}})
    (name, share, spans), = scanner(f"{prose(50, rng)} {body} {prose(50, rng)}")
    assert name == "long/text" and share == 1.0 and spans[0][1] - spans[0][0] == len(body)
    (name, share, _), = scanner(f"{prose(50, rng)} {edit(body, 300, rng)} {prose(50, rng)}")
    assert name == "long/text" and li.COVERAGE <= share < 1
    assert scanner("-" * 100_000) == [] and scanner(("- " * 50 + "\n") * 1000) == []


def full_table(pattern, text):
    """(edits, start, end) of the best place of a pattern, from the whole edit table."""
    row = [(0, j) for j in range(len(text) + 1)]
    for i, c in enumerate(pattern, 1):
        new = [(i, 0)]
        for j, d in enumerate(text, 1):
            new.append(min((row[j - 1][0] + (c != d), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[j - 1][0] + 1, new[j - 1][1])))
        row = new
    edits, end = min((x[0], j) for j, x in enumerate(row))
    return edits, row[end][1], end


def test_the_whole_query_equals_full_tables(spark):
    """Coverage, spans and the choice between rivals, recomputed window by window."""
    rng = random.Random(31)
    one, two, three = (prose(n, rng)[:size].strip() for n, size in ((40, 160), (40, 140), (60, 240)))
    rival = one[:70] + "zqx" + one[73:]  # another license, three letters apart
    templates = {"A/notice": one, "D/notice": rival, "B/notice": two, "C/text": three}
    rows = []
    for k, t in enumerate(list(templates.values()) * 6):
        rows.append((k, f"{prose(8, rng)} {edit(t, rng.randrange(4), rng) if k >= 4 else t} {prose(8, rng)}"))
    rows += [(100, f"{two} {prose(30, rng)} {one}"), (101, prose(60, rng)), (102, three[: len(three) // 2]), (103, None)]
    got = {}
    for r in li.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect():
        got.setdefault(r.doc_id, {})[f"{r.license}/{r.form}"] = (r.coverage, [(s.start, s.end) for s in r.spans])
    scanner = li.LicenseScanner(templates)
    for doc, text in rows:
        folded = "".join(map(chr, fold(text))) if text else ""
        best = {}
        for name, t in templates.items():
            covered, sure, places = np.zeros(len(t)), np.zeros(len(t)), []
            for w in scanner.windows:
                if w.item == name and folded:
                    edits, start, end = full_table("".join(map(chr, w.cp)), folded)
                    if edits <= w.edits:
                        fit = np.full(len(w.cp), 1 - edits / len(w.cp))
                        part = slice(w.start, w.start + len(w.cp))
                        covered[part] = np.maximum(covered[part], fit)
                        if edits <= 3:
                            sure[part] = np.maximum(sure[part], fit)
                        places.append((start, end))
            best[name] = (covered.mean(), sure.mean(), places)
        beaten = set()
        for x, y in (("A/notice", "D/notice"), ("D/notice", "A/notice")):
            if best[x][0] < best[y][0]:
                beaten.add(x)
        for name, (most, sure, places) in best.items():
            found = got.get(doc, {}).get(name)
            if found:
                assert name not in beaten and li.COVERAGE <= found[0] <= most + 1e-9 and found[0] >= sure - 1e-9
                assert all(any(abs(a - s) <= 6 or a >= s for s, _ in found[1]) for a, _ in places)
                assert min(s for s, _ in found[1]) >= min(a for a, _ in places) - 6 and max(e for _, e in found[1]) <= max(b for _, b in places) + 6
            else:
                assert name in beaten or sure < li.COVERAGE, (doc, name, best[name][:2])
    assert all(len(got.get(k, {})) == 1 for k in range(4)) and set(got[100]) == {"A/notice", "B/notice"} and not {101, 103} & set(got)
    assert [got[k][n][0] for k, n in enumerate(templates)] == [1.0] * 4
