"""Top chunks against brute force in numpy, with hot videos, null ids and unusable vectors."""

import collections
import math
import operator

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.operators import retrieval
from tests.helpers import plan, rows

SCHEMA = "video_id string, chunk_id int, text string, embedding array<double>"


def similarity_by_chunk(chunks):
    """Chunk to cosine with the mean of the unit vectors, from sums of single products."""
    units = {}
    for _, chunk, _, vector in chunks:
        if vector and None not in vector and all(map(math.isfinite, vector)):
            length = max(1e-6, math.sqrt(math.fsum(e * e for e in vector)))
            units[chunk] = [e / length for e in vector]
    centre = [math.fsum(place) / len(units) for place in zip(*units.values())]
    return {chunk: math.fsum(map(operator.mul, unit, centre)) for chunk, unit in units.items()}


def brute_force(data, k):
    picked = []
    by_video = collections.defaultdict(list)
    for row in data:
        by_video[row[0]].append(row)
    for video, chunks in by_video.items():
        found = similarity_by_chunk(chunks) or {row[1]: 0.0 for row in chunks}
        # A chunk is in when fewer than k others come before it.
        for chunk, own in found.items():
            before = sum(other > own or (other == own and c < chunk) for c, other in found.items())
            picked += [(video, chunk)] * (before < k)
    return sorted(picked, key=repr)


@pytest.fixture(scope="module")
def data():
    """One video holds a third of the chunks, the null id is a large group, one video has no vector."""
    rng = np.random.default_rng(7)
    made = []
    for i in range(900):
        video = "hot" if i % 3 == 0 else None if i % 3 == 1 and i % 2 else f"v{i % 17}"
        vector = [float(x) for x in rng.normal(size=6)]
        if i % 11 == 0:
            vector = None
        elif i % 13 == 0:
            vector[2] = float("nan")
        elif i % 29 == 0:
            vector = []
        elif i % 31 == 0:
            vector = [0.0] * 6
        if video == "v5":
            vector = None
        made.append((video, i, f"t{i}", vector))
    return made


def keys(df):
    return sorted(((r.video_id, r.chunk_id) for r in df.collect()), key=repr)



@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("k", [1, 12, 10_000])
@pytest.mark.parametrize("hot_rows", [200_000, 40])
def test_top_chunks(spark, data, k, hot_rows):
    chunks = spark.createDataFrame(data, SCHEMA)
    assert keys(retrieval.top_chunks(chunks, k, "embedding", hot_rows=hot_rows)) == brute_force(data, k)


def test_shuffled_join_with_hot_videos(spark, data, no_broadcast):
    chunks = spark.createDataFrame(data, SCHEMA)
    picked = retrieval.top_chunks(chunks, 12, "embedding", hot_rows=40)
    assert "SortMergeJoin" in plan(picked)
    assert keys(picked) == brute_force(data, 12)


def test_shuffled_join_without_sorting_vectors(spark, data, no_broadcast):
    chunks = spark.createDataFrame(data, SCHEMA)
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    spark.conf.set(name, "128m")
    try:
        picked = retrieval.top_chunks(chunks, 12, "embedding", hot_rows=40)
        assert keys(picked) == brute_force(data, 12)
        assert "ShuffledHashJoin" in plan(picked).split("Initial Plan")[0]
    finally:
        spark.conf.unset(name)


def test_one_shuffle_from_scores_to_contexts(spark, data):
    chunks = spark.createDataFrame(data, SCHEMA)
    found = plan(retrieval.contexts(retrieval.top_chunks(chunks, 12, "embedding")))
    assert found.count("Arguments: hashpartitioning") == 1


def test_arrow_batches_cut_anywhere(spark, data):
    chunks = spark.createDataFrame(data, SCHEMA)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "7")
    try:
        assert keys(retrieval.top_chunks(chunks, 12, "embedding")) == brute_force(data, 12)
    finally:
        spark.conf.unset(name)


def test_whole_number_vectors_and_keys(spark):
    chunks = spark.sql("select id % 2 video_id, cast(id as int) chunk_id, '' text, array(id, 1) emb from range(6)")
    assert keys(retrieval.top_chunks(chunks, 2, "emb")) == [(0, 2), (0, 4), (1, 3), (1, 5)]


def test_hot_list_stays_bounded(spark, data):
    chunks = spark.createDataFrame(data, SCHEMA)
    table = retrieval.stored_centroids(chunks, "embedding")
    hot = retrieval._hot_salts(table, 1, 4)
    assert 0 < hot.count() <= 4
    picked = retrieval.top_chunks(chunks, 12, "embedding", table, hot_rows=1, max_hot=4)
    assert keys(picked) == brute_force(data, 12)


def test_order_and_partitions_do_not_matter(spark, data):
    shuffled = spark.createDataFrame(data[::-1], SCHEMA).repartition(13, "chunk_id")
    assert keys(retrieval.top_chunks(shuffled, 12, "embedding")) == brute_force(data, 12)


def test_text_vectors(spark, data):
    chunks = spark.createDataFrame(data, SCHEMA).withColumn("embedding", F.to_json("embedding"))
    assert keys(retrieval.top_chunks(chunks, 12, "embedding")) == brute_force(data, 12)


def test_without_embedding_column(spark, data):
    chunks = spark.createDataFrame(data, SCHEMA).drop("embedding")
    bare = [(v, c, t, None) for v, c, t, _ in data]
    assert keys(retrieval.top_chunks(chunks, 4)) == brute_force(bare, 4)


def test_equal_vectors_go_by_chunk(spark):
    data = [("v", i, "", [1.0, 1.0]) for i in (5, 3, 9, 1)]
    chunks = spark.createDataFrame(data, SCHEMA)
    assert keys(retrieval.top_chunks(chunks, 2, "embedding")) == [("v", 1), ("v", 3)]


def test_mixed_sizes_are_rejected(spark):
    data = [("bad", 1, "", [1.0]), ("bad", 2, "", [1.0, 2.0]), ("good", 1, "", [1.0, 2.0]), ("good", 2, "", [])]
    chunks = spark.createDataFrame(data, SCHEMA)
    table = retrieval.stored_centroids(chunks, "embedding")
    assert rows(retrieval.vector_rejects(table)) == [("bad", 2, 2, 2)]
    assert keys(retrieval.top_chunks(chunks, 5, "embedding", table)) == [("good", 1)]


def test_tiny_and_large_vectors(spark):
    data = [("v", 1, "", [1e-9, 0.0]), ("v", 2, "", [0.0, 1e30]), ("v", 3, "", [3.0, 4.0])]
    table = retrieval.centroids(spark.createDataFrame(data, SCHEMA), "embedding").first()
    assert table.centroid == pytest.approx([(1e-3 + 0.6) / 3, 1.8 / 3])


def test_context_order_and_null_text(spark):
    chunks = spark.createDataFrame([("v", 2, "b", None), ("v", 1, None, None), ("v", 10, "c", None)], SCHEMA)
    contexts = retrieval.contexts(retrieval.top_chunks(chunks, 12, "embedding"))
    assert rows(contexts) == [("v", "\nb\nc")]


def test_sorted_nulls_last(spark):
    data = [(None, 1, "", None), ("b", 2, "", None), ("b", None, "", None), ("a", 3, "", None)]
    ordered = retrieval.in_chunk_order(spark.createDataFrame(data, SCHEMA)).collect()
    assert [(r.video_id, r.chunk_id) for r in ordered] == [("a", 3), ("b", 2), ("b", None), (None, 1)]


def test_plan_limits_before_the_shuffle(spark, data):
    text = plan(retrieval.top_chunks(spark.createDataFrame(data, SCHEMA), 12, "embedding"))
    assert text.count("WindowGroupLimit") >= 2
    assert "BatchEvalPython" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("copies", [1, 700])
def test_large_k_in_two_limits(spark, monkeypatch, copies):
    """Many equal rows of one video; the limit falls between them."""
    monkeypatch.setattr(retrieval, "PARTS", 4)
    rows_in = [("hot", i, f"t{i}", None) for i in range(2500)] + [("hot", None, "", None)] * copies + [("cold", 1, "t", None)]
    chunks = spark.createDataFrame(rows_in, SCHEMA)
    for k in (1001, 2600):
        got = collections.Counter((r.video_id, r.chunk_id) for r in retrieval.top_chunks(chunks, k).collect())
        hot = [i for i in range(2500)] + [None] * copies
        assert got == collections.Counter([("hot", c) for c in hot[:k]] + [("cold", 1)])


def test_large_k_limits_before_the_last_shuffle(spark):
    chunks = spark.createDataFrame([("v", 1, "t", None)], SCHEMA)
    assert plan(retrieval.top_chunks(chunks, 5000)).count("Window") >= 2
