"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into half-overlapping windows.  Each window's character k-grams are winnowed:
of every ``SPREAD`` k-grams in a row the one with the least hash goes into the inverted index, so
any shared stretch of ``K + 2 * SPREAD - 1`` characters meets the index twice on its diagonal.  Where
a document does, the window is aligned in a band around that diagonal.  Windows within their edit
budget add up to the covered share of the template.  Where templates of several licenses fit one
place (versions differ by a character), the one that matches most of it holds it.  Templates covered
to ``COVERAGE`` are reported.

Templates are a parameter; their index is broadcast, and ``MAX_TEMPLATE_CHARS`` bounds it.

Defined cases: null or empty texts hold no license; letter case and the kind of white space don't
count; several places of a template in one document give one row with all spans; where two licenses
fit a place equally well, both are reported; texts of any length are scanned whole, in overlapping
spans, and repetitive ones in slices of bounded size; repeated rows repeat in the result; null keys
stay null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .alignment import banded
from .passages import SPAN, GramIndex, Shapes, Window, crowded, cut_windows, fold, meetings, short_hashes
from .syncmers import sliding_min

K, SPREAD = 8, 4
WINDOW = 120
RATE = 0.1
COVERAGE = 0.7
MAX_TEMPLATE_CHARS = 1 << 21
#: Alignments that a text's scan remembers.
KNOWN = 50_000

#: Notices, headers and the parts of short licenses, by name of license and form.
TEMPLATES = {
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0/header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0/disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT/notice": "Released under the MIT License",
    "MIT/grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction",
    "MIT/condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT/disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0/notice": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0/header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1/header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
    "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD/grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD/conditions": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.",
    "BSD-3-Clause/endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.",
    "ISC/grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.",
    "Zlib/grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
    "subject to the following restrictions",
    "BSL-1.0/header": "Distributed under the Boost Software License, Version 1.0.",
    "Unlicense/grant": "This is free and unencumbered software released into the public domain.",
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "EPL-2.0/header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    **{f"CC-{kind}-{version}/notice": f"Licensed under CC {kind} {version}" for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for version in ("4.0", "3.0")},
}


def winnow(h: np.ndarray, spread: int) -> np.ndarray:
    """Places of the least hash (the last of equals) in every ``spread`` hashes in a row."""
    if len(h) <= spread:
        return np.array([len(h) - 1 - int(h[::-1].argmin())]) if len(h) else np.zeros(0, np.int64)
    least = sliding_min(h, spread)
    back = np.argmax(np.stack([h[spread - 1 - j : len(h) - j] == least for j in range(spread)]), axis=0)
    return np.unique(np.arange(len(least)) + spread - 1 - back)


class LicenseScanner:
    def __init__(self, templates: dict[str, str]):
        self.windows: list[Window] = [w for name, t in templates.items() for w in cut_windows(name, t, WINDOW, RATE, K)]
        entries = []
        for i, w in enumerate(self.windows):
            h = short_hashes(w.cp, K)
            at = winnow(h, SPREAD)
            entries.append((h[at], at, i))
        self.index = GramIndex(K, entries)
        self.reach = max((len(w.cp) + 2 * w.edits for w in self.windows), default=K)
        self.edits = np.array([w.edits for w in self.windows], dtype=np.int64)
        # two distinct fingerprints of a window in a band; a lone one is a chance
        two, whole = np.full(len(self.windows), 2), np.full(len(self.windows), WINDOW)
        self.shapes = Shapes(two, whole, self.edits + 1, 2 * WINDOW + 1, self.reach, (0,))

    def __call__(self, text: str) -> list[tuple[str, float, list[tuple[int, int]]]]:
        """(template, coverage, spans) of every template covered enough where no rival fits better."""
        if not text or not self.windows:
            return []
        found: set[tuple[int, int, int, int]] = set()
        for a in range(0, max(1, len(text) - 2 * self.reach), SPAN - 2 * self.reach):
            found |= {(w, start + a, end + a, edits) for w, start, end, edits in self._span(fold(text[a : a + SPAN]))}
        by_name: dict[str, list] = {}
        for w, start, end, edits in found:
            by_name.setdefault(self.windows[w].item, []).append((start, end, w, edits))
        places = [(*s, name, hits) for name, all_hits in by_name.items() for s, hits in self._places(all_hits)]
        out: dict[str, list] = {}
        for start, end, name, hits in self._undisputed(places):
            out.setdefault(name, []).append(((start, end), hits))
        reported = []
        for name, kept in sorted(out.items()):
            if (share := float(self._covered([h for _, hits in kept for h in hits]).mean())) >= COVERAGE:
                reported.append((name, share, sorted(s for s, _ in kept)))
        return reported

    @staticmethod
    def _places(hits: list) -> list[tuple[tuple[int, int], list]]:
        """The spans of a template's hits, those that touch as one, each with its hits."""
        out: list = []
        for hit in sorted(hits):
            if out and hit[0] <= out[-1][0][1]:
                (start, end), held = out[-1]
                held.append(hit)
                out[-1] = ((start, max(end, hit[1])), held)
            else:
                out.append(((hit[0], hit[1]), [hit]))
        return out

    def _covered(self, hits: list) -> np.ndarray:
        """How well the hits cover each character of their template, from 0 to 1."""
        covered = np.zeros(self.windows[hits[0][2]].item_size)
        for _, _, w, edits in hits:
            v = self.windows[w]
            part = covered[v.start : v.start + len(v.cp)]
            np.maximum(part, 1 - edits / len(v.cp), out=part)
        return covered

    def _undisputed(self, places: list) -> list:
        """Places without a better fitting one of another license over half of them or more.

        Versions and variants of one license differ by a few characters, well within the edit budget
        of each other; the one that matches most characters holds the place, of equals the shorter.
        """
        places = sorted(places, key=lambda p: p[:3])
        covered = [self._covered(p[3]) for p in places]
        fit = [(round(float(c.sum()), 6), -len(c)) for c in covered]
        lost = set()
        for i, (a, b, name, _) in enumerate(places):
            for j in range(i + 1, len(places)):
                c, d, other, _ = places[j]
                if c >= b:
                    break
                shared = min(b, d) - c
                if name.split("/")[0] != other.split("/")[0] and fit[i] != fit[j]:
                    worse, size = (i, b - a) if fit[i] < fit[j] else (j, d - c)
                    if 2 * shared >= size:
                        lost.add(worse)
        return [p for i, p in enumerate(places) if i not in lost]

    def _span(self, cp: np.ndarray) -> list[tuple[int, int, int, int]]:
        if len(cp) < K:
            return []
        at, k = self.index.present(cp)
        keep = crowded(at, self.reach, 2)
        if not keep.any():
            return []
        hits = []
        wide = 3 * int(self.edits.max()) + 2
        # equal stretches far apart are hits of their own, so no region is passed over, but aligned once
        known: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        for met in meetings(self.index, cp, at[keep], k[keep], self.shapes, None):
            for part in range(0, len(met.pattern), 512):
                chosen = [(w, max(0, low - int(self.edits[w]))) for w, low in zip(met.pattern[part : part + 512].tolist(), met.low[part : part + 512].tolist())]
                regions = [cp[begin : begin + len(self.windows[w].cp) + 3 * int(self.edits[w]) + 1] for w, begin in chosen]
                keys = [(w, r.tobytes()) for (w, _), r in zip(chosen, regions)]
                new = {key: r for key, r in zip(keys, regions) if key not in known}
                if len(known) > KNOWN:
                    known = {key: known[key] for key in keys if key in known}
                known.update(zip(new, banded([self.windows[w].cp for w, _ in new], list(new.values()), wide)))
                for (w, begin), key in zip(chosen, keys):
                    edits, start, end = known[key]
                    if edits <= self.edits[w]:
                        hits.append((w, begin + start, begin + end, edits))
        return hits


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document and template found: covered share and the spans in the text."""
    templates = TEMPLATES if templates is None else templates
    if sum(map(len, templates.values())) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_CHARS} characters; scan with parts of them in turn")
    shipped = docs.sparkSession.sparkContext.broadcast(templates)
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(shipped.value)
        for b in batches:
            rows = [(i, *found) for i, t in enumerate(b.column("text").to_pylist()) for found in scanner(t)]
            at, names, shares, spans = zip(*rows) if rows else ((),) * 4
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            places = pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], span)
            forms = [n.partition("/") for n in names]
            columns = [pa.array([f[0] for f in forms], pa.string()), pa.array([f[2] for f in forms], pa.string()), pa.array(shares, pa.float64()), places]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(at, pa.int64())), *columns], ["doc_id", "license", "form", "coverage", "spans"])

    return slim.mapInArrow(scan, f"doc_id {kind}, license string, form string, coverage double, spans array<struct<start:long,end:long>>")
