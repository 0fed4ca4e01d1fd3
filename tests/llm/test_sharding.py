import zlib

import pytest

from chunkloom.llm import sharding
from tests.llm import samples


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    by = {s: [r for r in rows if r.shard == s] for s in range(shards)}
    assert sum(map(len, by.values())) == len(rows)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    want = sorted((i is None, i or 0, 16 + len((t or "").encode()), None if t is None else zlib.crc32(t.encode())) for i, t in texts)
    key = lambda r: (r[0], r[1], r[2], r[3] or 0)
    assert sorted(((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in rows), key=key) == sorted(want, key=key)
    assert {(r.law, r.grown_shard) for r in rows} <= {("bytes", None)}
    return [sum(r["size"] for r in own) for own in by.values()]


def test_edges(spark):
    texts = samples.edge_texts()
    df = samples.with_clashes(samples.documents(spark, texts))
    check(sharding.assign(df, 4).collect(), texts, 4)
    check(sharding.assign(df, 50).collect(), texts, 50)
    assert sharding.assign(df.limit(0), 4).collect() == []


def test_balance_with_a_hot_text(spark):
    texts = [(i, "the same text" if i % 3 == 0 else samples.words(i, i % 97)) for i in range(6000)]
    loads = check(sharding.assign(samples.documents(spark, texts), 7, ranges_per_shard=2).collect(), texts, 7)
    assert max(loads) - min(loads) < 700


def test_large_records_do_not_break_the_balance(spark):
    texts = [(i, "x" * (40_000 if i < 5 else 10 + i % 50)) for i in range(5000)]
    loads = check(sharding.assign(samples.documents(spark, texts), 10).collect(), texts, 10)
    assert max(loads) < 1.01 * max(sum(loads) / 10, 40_016)


@pytest.mark.parametrize("n", [1, 5, 50, 300])
def test_range_lookup(spark, n):
    bounds = [10 * i for i in range(1, n + 1)]
    from pyspark.sql import functions as F

    got = spark.range(-5, 10 * n + 25).select("id", sharding.range_of(F.col("id"), bounds).alias("r")).collect()
    assert all(r.r == sum(b <= r.id for b in bounds) for r in got)


def test_files_hold_their_shards(spark, tmp_path):
    df = samples.documents(spark, [samples.words(i, 20) for i in range(60)])
    assigned = sharding.assign(df, 3)
    sharding.write(df, assigned, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r.shard) for r in assigned.collect()}
