import random

import pytest
from pyspark.sql import functions as F

from chunkloom.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k):
    usable = [
        (i, [int(__import__("math").floor(1024 * float(x))) for x in v])
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and abs(x) < float("inf") for x in v)
    ]
    out = set()
    for q, a in usable:
        if q % 10 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in usable if c != q and len(a) == len(b))
            out |= {(q, n, c, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, c) in enumerate(scored[:k], 1)}
    return out


@pytest.mark.parametrize("sizes", [(4096, 32768), (3, 7)])
def test_against_all_pairs(spark, sizes):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-0.5, 0.25, 0.1, 1.0]) for _ in range(3)], 0) for i in range(150)]
    rows += [(i, rows[20][1], 0) for i in range(200, 240)]  # ties
    rows += [(300, [0.5, 0.5], 0), (301, [0.25, 1.0], 0), (310, [], 0), (311, [], 0)]
    rows += [(320, None, 0), (330, [1.0, None, 0.0], 0), (340, [float("nan"), 0.0, 1.0], 0), (350, [float("inf"), 0.0, 0.0], 0), (None, [1.0, 1.0, 1.0], 0)]
    got = topk.exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, 5, query_block=sizes[0], shard=sizes[1])
    assert {tuple(r) for r in got.collect()} == brute(rows, 5)


def test_products_beyond_doubles_and_longs(spark):
    rows = [(10, [2.0**40, 1.0], 0), (1, [2.0**40, 1.0], 0), (2, [2.0**20, 3.0], 0), (3, [-(2.0**40), 0.0], 0)]
    got = topk.exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 10, 9)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == sorted(brute(rows, 9), key=lambda r: r[1])


def test_empty_table(spark):
    assert topk.exact_top_k(spark.createDataFrame([], SCHEMA), F.lit(True), 5).collect() == []
