"""Shards against the stated law and against a loop; SQL oracles of the text operators."""

import collections
import hashlib
import os
import random
import zlib

import pytest

from voxloom.llm import sharding

SCHEMA = "doc_id long, text string, source string, shard string, slot int"


def rows():
    rng = random.Random(4)
    out = [(i, f"text {i}" * rng.randrange(4), rng.choice(["hot"] * 5 + ["a", "b", None]), "x", 1) for i in range(500)]
    return out + [(1000 + i, t, s, "x", 1) for i, (t, s) in enumerate([(None, "a"), ("", "b"), ("é\U0001f600", None), ("dup", "lone")])] + [(7, "dup", "a", "x", 1)] * 3 + [(None, "n", None, "x", 1)]


def loop(rows, n_shards):
    by = collections.defaultdict(list)
    for i, t, s, *_ in rows:
        crc, size = zlib.crc32((t or "").encode()), len((t or "").encode()) + 1
        d = hashlib.md5(f"{sharding.SEED}:{'' if i is None else i}:{crc}:{size}".encode()).hexdigest()
        by[s].append((d, -1 if i is None else i, crc, size))
    ranked = []
    for s, have in by.items():
        for r, x in enumerate(sorted(have), 1):
            ranked.append(((2 * r - 1) / (2 * len(have)), "" if s is None else f"={s}", x))
    out = collections.Counter()
    start = collections.Counter()
    for pos, (_, s, (_, i, crc, size)) in enumerate(sorted(ranked)):
        shard = pos * n_shards // len(ranked)
        out[(i, size, crc, shard, start[shard])] += 1
        start[shard] += 1
    return out


@pytest.mark.parametrize("per_bucket,least", [(100_000, 256), (50, 1), (10**9, 1)])
def test_shards_equal_a_loop(spark, per_bucket, least):
    have = rows()
    got = sharding.interleave_shards(spark.createDataFrame(have, SCHEMA).repartition(5), rows_per_bucket=per_bucket, least_buckets=least).collect()
    assert collections.Counter((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == loop(have, 16)
    counts = collections.Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_null_and_repeated_keys_and_copies(spark, monkeypatch):
    """Hot keys spread over cells by their texts; copies move as one row."""
    monkeypatch.setattr(sharding, "DEALT", 7)
    have = [(None, f"t{i}", "hot", "x", 1) for i in range(300)] + [(5, f"u{i}", "hot", "x", 1) for i in range(300)] + [(None, "copy", "hot", "x", 1)] * 300 + [(6, "x" * 3_000_000, "a", "x", 1)]
    df = sharding.interleave_shards(spark.createDataFrame(have, SCHEMA).repartition(3))
    assert collections.Counter((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in df.collect()) == loop(have, 16)


def test_every_shard_matches_the_mixture(spark):
    have = rows()
    got = sharding.interleave_shards(spark.createDataFrame(have, SCHEMA), 8).collect()
    total = collections.Counter(r.source for r in got)
    for s in range(8):
        mine = collections.Counter(r.source for r in got if r.shard == s)
        for source, n in total.items():
            assert abs(mine[source] - n / 8) <= 1.5 + len(total) / 8


def test_empty_and_few(spark):
    assert sharding.interleave_shards(spark.createDataFrame([], SCHEMA)).collect() == []
    got = sharding.interleave_shards(spark.createDataFrame([(1, "a", "s", "x", 1), (2, "b", "s", "x", 1)], SCHEMA)).collect()
    assert sorted(r.shard for r in got) == [0, 8] and {r.slot for r in got} == {0}


def test_main_path_is_native(spark):
    plan = sharding.interleave_shards(spark.createDataFrame(rows(), SCHEMA))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow", "Cartesian", "NestedLoop"))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_registered_sql(spark):
    import duckdb

    from tests.test_oracles import rows as plain_rows
    from voxloom.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet{'/*.parquet' if os.path.isdir(sf + '/documents.parquet') else ''}'")
    for name, sql in queries.oracle_sql().items():
        assert plain_rows(queries.queries()[name](spark, sf).toPandas()) == plain_rows(con.sql(sql).df()), name


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("n", range(1, 14))
def test_each_operator_returns_its_contract(spark, n):
    from voxloom.llm import queries

    need = {
        1: {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
        3: {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
        5: {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
        6: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
        7: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        9: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
        11: {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
        12: {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
        13: {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
        10: {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    }.get(n, {"doc_id": "bigint"})
    name = next(q for q in queries.queries() if q.startswith(f"op{n}_"))
    df = queries.queries()[name](spark, "/root/testdata/sf0.001")
    assert need.items() <= dict(df.dtypes).items()
    if n in (1, 3, 4, 5, 6, 7, 9, 10, 12):
        assert df.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
