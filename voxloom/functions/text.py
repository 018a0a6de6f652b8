"""Text as column expressions."""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.strip() sees it.
BLANKS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"

#: Letters that are one letter in Persian, the joiner, and both sets of digits.
LETTERS_FROM, LETTERS_TO = "يىكة‌", "ییکه "
DIGITS_FROM, DIGITS_TO = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789"
#: Vowel signs, and what is kept besides letters and digits (blanks, of any kind, are among the rest).
MARKS = r"[\x{064b}-\x{0652}\x{0670}]"
NOT_KEPT = r"[^\p{L}\p{N}_\x{0600}-\x{06FF}]"


#: Where LETTERS, DIGITS or MARKS may occur.
ARABIC = r"[\x{0600}-\x{06FF}\x{200C}]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANKS}+|{BLANKS}+$", "")


def collapse(c: Column) -> Column:
    """No blanks at the ends and one between words; what is left of runs of blanks is a space."""
    return F.trim(F.regexp_replace(c, f"{BLANKS}+", " "))


def _forms(texts: pa.Array) -> pa.Array:
    """Only texts that have another form become Python strings again."""
    other = pc.invert(pc.fill_null(pc.string_is_ascii(texts), True)).to_numpy(zero_copy_only=False)
    changed = {}
    for i in np.flatnonzero(other).tolist():
        t = texts[i].as_py()
        if not unicodedata.is_normalized("NFKC", t):
            changed[i] = unicodedata.normalize("NFKC", t)
    if not changed:
        return texts
    mask = np.zeros(len(texts), bool)
    mask[list(changed)] = True
    return pc.replace_with_mask(texts, pa.array(mask), pa.array(list(changed.values()), texts.type))


@F.arrow_udf(T.StringType())
def compatibility_form(s: pa.Array) -> pa.Array:
    """NFKC, which has no built-in function."""
    return _forms(s)


@F.arrow_udf(T.StructType().add("one", "string").add("two", "string"))
def compatibility_forms(one: pa.Array, two: pa.Array) -> pa.Array:
    """NFKC of two texts, which reach Python together."""
    return pa.StructArray.from_arrays([_forms(one), _forms(two)], ["one", "two"])


def _one_spelling(form: Column) -> Column:
    """Letters, digits and marks only where there may be any; then all that isn't kept, blanks among it, is one space."""
    plain = F.regexp_replace(F.translate(form, LETTERS_FROM + DIGITS_FROM, LETTERS_TO + DIGITS_TO), MARKS, "")
    return F.trim(F.regexp_replace(F.when(form.rlike(ARABIC), plain).otherwise(form), f"{NOT_KEPT}+", " "))


def normalize_persian(c: Column) -> Column:
    """One spelling for what differs only in writing; null becomes empty."""
    return _one_spelling(compatibility_form(F.coalesce(c, F.lit(""))))


def script_ratio(c: Column, low: str = "0600", high: str = "06FF") -> Column:
    """Share of digits and of letters between two code points among all letters and digits."""
    digits = F.regexp_count(c, F.lit(r"\p{Nd}"))
    ours = F.regexp_count(c, F.lit(rf"[\x{{{low}}}-\x{{{high}}}&&\p{{L}}]"))
    letters = F.regexp_count(c, F.lit(r"\p{L}"))
    return F.coalesce(F.try_divide((ours + digits).cast("double"), (letters + digits).cast("double")), F.lit(0.0))


def safe_id(c: Column) -> Column:
    """At most 80 characters fit for a file name."""
    return F.substring(F.regexp_replace(c, r"[^\p{L}\p{N}]", "_"), 1, 80)


def preview(c: Column, size: int = 45) -> Column:
    return F.replace(F.substring(c, 1, size), F.lit("\n"), F.lit(" "))


#: Pairs of equal runs of words that the block search holds at once, and the longest runs that it begins with.
MAX_PAIRS, MAX_RUN = 1 << 20, 64
#: Pairs a word from which on the search begins with longer runs, if they have fewer pairs.
FEW_PAIRS = 16
#: Rows whose words are coded together, and words of a that are searched together.
ROWS, WORDS = 500, 1 << 17


class _Blocks:
    """Matching blocks of two rows of words: the longest common run (the first in a, then in b), then the same to its left and right.
    Both rows may hold several texts, as the first parts (columns of begin and end in a, begin and end in b).

    Runs of ``size`` words or more are found at once, as stretches of diagonals; a part of the texts clips them.  All parts
    advance together: of the longest runs of a part the first is taken, then the first behind it, and so on, as between
    them none is as long; the gaps are the next parts.  A part that has no run left is searched for shorter ones, in
    itself.  Without runs of two the rule is to take each word of a in turn where b has it next.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.n, self.split = len(x), len(x) + 1
        self.grams = [np.concatenate([x, [-1], y, [-2]])]  # by size; a run over an end of a text equals no other
        self.out = np.zeros(len(x), bool)

    def gram(self, size: int) -> np.ndarray:
        while len(self.grams) < size:
            last, n = self.grams[-1], len(self.grams)
            key = last[:-1] * (int(self.grams[0].max(initial=0)) + 3) + self.grams[0][n:] + 2
            self.grams.append(np.unique(key, return_inverse=True)[1])
        return self.grams[size - 1]

    def pairs(self, a0: int, a1: int, b0: int, b1: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(order of b's runs, first of each of a's among them, how many of each, places of a's)"""
        g = self.gram(size)
        x, y = g[a0 : max(a1 - size + 1, a0)], g[self.split + b0 : max(self.split + b1 - size + 1, self.split + b0)]
        order = np.argsort(y, kind="stable")
        low, high = np.searchsorted(y[order], x, "left"), np.searchsorted(y[order], x, "right")
        return order + b0, low, high - low, np.arange(a0, a0 + len(x))

    def runs(self, a0: int, a1: int, b0: int, b1: int, size: int) -> np.ndarray:
        """Rows diagonal, begin and end (in a) of the maximal common runs of ``size`` or more."""
        order, low, n, place = self.pairs(a0, a1, b0, b1, size)
        i = np.repeat(place, n)
        if not len(i):
            return np.zeros((3, 0), np.int64)
        d = order[np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(len(i))] - i
        by = np.lexsort((i, d))
        i, d = i[by], d[by]
        opens = np.flatnonzero((np.diff(d, prepend=d[:1] - 1) != 0) | (np.diff(i, prepend=-2) != 1))
        return np.stack([d[opens], i[opens], i[np.append(opens[1:], len(i)) - 1] + size])

    def first_size(self, n_b: int) -> int | None:
        """The least size from two on with few enough pairs to hold, or a longer one with few pairs a word."""
        held = None
        for size in range(2, MAX_RUN + 1):
            n = int(self.pairs(0, self.n, 0, n_b, size)[2].sum())
            if n <= MAX_PAIRS:
                held = held or size
                if n <= FEW_PAIRS * self.n:
                    return size
        return held

    def search(self, parts: np.ndarray, size: int) -> None:
        d, s, e = self.runs(parts[0, 0], parts[1, -1], parts[2, 0], parts[3, -1], size)
        while True:
            low = np.searchsorted(parts[1], s, "right")
            n = np.maximum(np.searchsorted(parts[0], e, "left") - low, 0)
            d, s, e = (np.repeat(v, n) for v in (d, s, e))
            part = np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(d))
            s, e = np.maximum(s, np.maximum(parts[0, part], parts[2, part] - d)), np.minimum(e, np.minimum(parts[1, part], parts[3, part] - d))
            there = e - s >= size
            d, s, e, part = d[there], s[there], e[there], part[there]
            n = np.bincount(part, minlength=parts.shape[1])
            for a0, a1, b0, b1 in parts[:, (n == 0) & (parts[0] < parts[1]) & (parts[2] < parts[3])].T.tolist():
                self.singles(a0, a1, b0, b1) if size == 2 else self.search(np.array([[a0], [a1], [b0], [b1]]), size - 1)
            if not len(d):
                return
            part, parts = (np.cumsum(n > 0) - 1)[part], parts[:, n > 0]
            most = np.zeros(parts.shape[1], np.int64)
            np.maximum.at(most, part, e - s)
            longest = np.flatnonzero(e - s == most[part])
            longest = longest[np.lexsort((d[longest], s[longest], part[longest]))]
            taken, own, at, to = [], -1, 0, 0
            for k, p, i, j, m in zip(longest.tolist(), part[longest].tolist(), s[longest].tolist(), (s + d)[longest].tolist(), most[part[longest]].tolist()):
                if p != own or i >= at and j >= to:
                    taken.append(k)
                    own, at, to = p, i + m, j + m
            begin, end, off, of = s[taken], e[taken], d[taken], part[taken]
            places = np.repeat(begin, end - begin)
            self.out[places + np.arange(len(places)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin)] = True
            before = np.arange(len(taken)) + of  # the gap before each block taken; a part has one more than blocks
            gaps = np.zeros((4, len(taken) + parts.shape[1]), np.int64)
            first = np.searchsorted(of, np.arange(parts.shape[1])) + np.arange(parts.shape[1])
            last = np.append(first[1:], gaps.shape[1]) - 1
            gaps[0, first], gaps[2, first], gaps[1, last], gaps[3, last] = parts[0], parts[2], parts[1], parts[3]
            gaps[1, before], gaps[3, before], gaps[0, before + 1], gaps[2, before + 1] = begin, begin + off, end, end + off
            parts = gaps

    def singles(self, a0: int, a1: int, b0: int, b1: int) -> None:
        there: dict[int, list[int]] = {}
        for j, w in enumerate(self.grams[0][self.split + b0 : self.split + b1].tolist()):
            there.setdefault(w, []).append(j)
        at = 0
        for i, w in enumerate(self.grams[0][a0:a1].tolist(), a0):
            places = there.get(w)
            if places:
                k = bisect_left(places, at)
                if k < len(places):
                    self.out[i] = True
                    at = places[k] + 1


def matched_words(a: list[str], b: list[str]) -> np.ndarray:
    """Which words of a lie in matching blocks with b."""
    number: dict[str, int] = {}
    return _matched_codes(*(np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64) for words in (a, b)))


def _matched_codes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same for words as numbers.  Texts that repeat so much that even long runs have too many pairs go word by word."""
    if not len(x) or not len(y):
        return np.zeros(len(x), bool)
    blocks = _Blocks(x, y)
    size = blocks.first_size(len(y))
    if size is None:
        for m in SequenceMatcher(None, x.tolist(), y.tolist(), autojunk=False).get_matching_blocks():
            blocks.out[m.a : m.a + m.size] = True
    else:
        blocks.search(np.array([[0], [len(x)], [0], [len(y)]]), size)
    return blocks.out


def _matched_texts(x: np.ndarray, own: np.ndarray, y: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The same for many pairs of texts, whose words lie between bounds; those of few equal runs are searched together."""
    texts = np.arange(len(own) - 1)
    # a word of another text is another word
    x, y = (np.repeat(texts, np.diff(bounds)) * (max(x.max(initial=0), y.max(initial=0)) + 1) + v for v, bounds in ((x, own), (y, other)))
    blocks = _Blocks(x, y)
    n = np.append(0, np.cumsum(blocks.pairs(0, len(x), 0, len(y), 2)[2]))[np.minimum(own, max(len(x) - 1, 0))]
    few = (np.diff(n) <= FEW_PAIRS * np.diff(own)) & (np.diff(n) <= MAX_PAIRS)
    parts = np.stack([own[:-1], own[1:], other[:-1], other[1:]])
    for i in np.flatnonzero(~few).tolist():
        a0, a1, b0, b1 = parts[:, i].tolist()
        blocks.out[a0:a1] = _matched_codes(x[a0:a1], y[b0:b1])
    parts = parts[:, few & (parts[0] < parts[1]) & (parts[2] < parts[3])]
    if parts.shape[1]:
        blocks.search(parts, 2)
    return blocks.out


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words, bounds of each text's) of texts in which single blanks part words."""
    found = pc.split_pattern(pc.fill_null(texts, ""), " ")
    words, n = found.flatten(), pc.list_value_length(found).to_numpy().astype(np.int64)
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    upto = np.append(0, np.cumsum(real))
    return words.filter(pa.array(real)), upto[np.append(0, np.cumsum(n))]


@F.arrow_udf(T.StructType().add("score", "double").add("missed", T.ArrayType(T.StringType())))
def _matched(ref: pa.Array, hyp: pa.Array) -> pa.Array:
    """Both texts are normalised; the matcher is Ratcliff-Obershelp's, which no built-in function is."""
    scores, lists = [], []
    for row in range(0, len(ref), ROWS):
        (words, own), (heard, other) = _split(ref[row : row + ROWS]), _split(hyp[row : row + ROWS])
        coded = pa.concat_arrays([words, heard]).dictionary_encode().indices.to_numpy().astype(np.int64)
        x, y = coded[: len(words)], coded[len(words) :]
        second = hyp[row : row + ROWS].is_valid().to_numpy(zero_copy_only=False)
        missed = np.repeat(second, np.diff(own))
        at = 0
        while at < len(second):
            to = max(at + 1, int(np.searchsorted(own, own[at] + WORDS, "right")) - 1)
            here, there = slice(own[at], own[to]), slice(other[at], other[to])
            missed[here] &= ~_matched_texts(x[here], own[at : to + 1] - own[at], y[there], other[at : to + 1] - other[at])
            at = to
        upto = np.append(0, np.cumsum(missed))[own]
        n = np.diff(own)
        scores.append(pa.array((n - np.diff(upto)) / np.maximum(n, 1), mask=~second | (n == 0)))
        lists.append(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words.filter(pa.array(missed)).cast(pa.string())))
    if not scores:
        return pa.array([], pa.struct([("score", pa.float64()), ("missed", pa.list_(pa.string()))]))
    return pa.StructArray.from_arrays([pa.concat_arrays(scores), pa.concat_arrays(lists)], ["score", "missed"])


def agreement(ref: Column, hyp: Column) -> Column:
    """score: share of the reference's words that the second text has in matching blocks (null
    without a second text or without words); missed: the others, in order."""
    forms = compatibility_forms(F.coalesce(ref, F.lit("")), hyp)
    return _matched(_one_spelling(forms["one"]), _one_spelling(forms["two"]))
