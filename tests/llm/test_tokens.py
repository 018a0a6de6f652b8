"""Token counts and the codec against the tokenizers library itself."""

import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from voxloom.llm import bpe_codec, token_counts  # noqa: E402
from voxloom.llm.bpe import read_vocabulary  # noqa: E402

PATH = P.path("byte_bpe_50k.json")
HARD = [
    None, "", " ", "\n\n  \n", "a", "don't we'll I'M", "x<|endoftext|>y", "<|endoftext|>", "<|endoftext|><|endoftext|>  z", "<|endoftext|",
    "naïve café Ünïcödé", "日本語のテキスト、そして。", "\U0001f600\U0001f601 ok", "a\u0085b c d", "՘࢏ odd ꟎", "0123456789" * 30, "aaaa" * 500, "'''re''s", "\t\t x \r\n y  ", "ééé" * 100,
]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def long_texts():
    rng = random.Random(5)
    words = ["the", " of", "  ", "\n", "don't", "été", "x<|endoftext|>", "日本", "qqqq", "!!", "'re", " 12", "\U0001f600"]
    return ["".join(rng.choice(words) for _ in range(n)) for n in (3000, 30000)] + ["a" * 5000, "ab " * 4000 + "z" * 9000 + " ." * 900]


def table(spark, texts):
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)] + [(None, "dup", "x", 1), (0, texts[0], "clash", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int")


def test_counts_equal_library(spark):
    texts, lib = HARD + long_texts(), library()
    got = token_counts.count_tokens(table(spark, texts), PATH).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = "dup" if r.doc_id is None else texts[r.doc_id] or ""
        n = len(lib.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 512), t[:50]


def test_proof_holds_for_every_claimed_token():
    lib = library()
    for s in token_counts.prove_whole_tokens(read_vocabulary(PATH)):
        assert len(lib.encode(s, add_special_tokens=False).ids) == 1


@pytest.mark.parametrize("split_over,leaf", [(32_768, 16_384), (7, 5), (200, 64)])
def test_codec_equals_library_and_round_trips(spark, split_over, leaf):
    texts, lib = HARD + (long_texts() if leaf > 5 else []), library()
    got = bpe_codec.encode_documents(table(spark, texts), PATH, split_over=split_over, leaf=leaf, with_ids=True).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = "dup" if r.doc_id is None else texts[r.doc_id] or ""
        ids = lib.encode(t, add_special_tokens=False).ids
        assert list(r.ids) == ids, t[:50]
        assert r.decoded == t and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_join_is_exact_at_every_cut():
    codec = bpe_codec.Codec(read_vocabulary(PATH))
    text = "I don't  know\n\n  what 'tis, été 1234 naïve!!  end" * 3
    whole = codec.plain(text)
    for cut in range(len(text) + 1):
        for w in (1, 4):
            assert np.array_equal(codec.join(codec.plain(text[:cut]), codec.plain(text[cut:]), w), whole)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(empty, PATH).collect() == []
    assert bpe_codec.encode_documents(empty, PATH).collect() == []
