"""Joins on a key that holds most rows are split at run time."""

import contextlib

import pytest
from pyspark.sql import functions as F

from chunkloom.operators import metadata, segments, serving
from chunkloom.plans.build import build_chunks
from chunkloom.session import stored
from tests.helpers import plan

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@contextlib.contextmanager
def configured(spark, settings):
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.fixture(scope="module")
def turns(spark):
    """Two thirds of 60,000 segments belong to one video."""
    key = F.when(F.col("n") % 3 != 0, "hot").otherwise(F.concat(F.lit("v"), F.col("n") % 500))
    return spark.range(0, 60_000, 1, 8).withColumnRenamed("id", "n").select(
        key.alias("video_id"), F.col("n").cast("string").alias("id"), F.lit("1").alias("start"),
        F.lit("2").alias("end"), F.sha2(F.col("n").cast("string"), 256).alias("text"),
    )


@pytest.fixture(scope="module")
def videos(turns):
    known = turns.select("video_id").distinct()
    return stored(known.withColumns({"title": F.lit("t"), "upload_date": F.lit("2025-01-01")}), "videos")


def final_plan(df, rows):
    """Formatted plan after a run that gave the expected number of rows."""
    got = df.collect()
    assert len(got) == rows
    return plan(df)


def test_video_join(spark, turns, videos):
    with configured(spark, SMALL):
        assert "skew=true" in final_plan(segments.attach_videos(turns, videos), 60_000)


def test_build(spark, turns, videos):
    entries = videos.select(F.col("video_id").alias("id"), "title", F.lit("20250101").alias("upload_date"))
    images = turns.select("video_id", F.col("id").cast("int").alias("chunk_id")).filter("chunk_id % 2 = 0")
    with configured(spark, SMALL):
        chunks = build_chunks(entries, turns, images, second_source=videos).chunks.drop("embedding")
        assert "skew=true" in final_plan(chunks, 60_000)
        assert chunks.filter("image_path is null").count() == 30_000


def test_repair_of_repeated_listing(spark, turns, videos):
    listed = turns.select("video_id", F.lit("").alias("title"), F.left("text", F.lit(0)).alias("upload_date"), "text")
    listed = listed.withColumn("upload_date", F.nullif("upload_date", F.lit("")))
    source = videos.unionAll(videos)
    with configured(spark, SMALL):
        repaired = metadata.repair(listed, source, source)
        assert "skew=true" in final_plan(repaired, 60_000)
        assert repaired.filter("upload_date = '2025-01-01' and title = 't'").count() == 60_000


def test_listing_groups_before_it_joins(spark, turns, videos):
    chunks = turns.withColumns({"title": F.lit("t"), "upload_date": F.lit("2025-01-01")})
    with configured(spark, SMALL):
        listing = serving.with_summary(serving.latest_per_title(chunks), videos)
        assert listing.count() == videos.count()


def test_clustered_layout_splits_the_hot_video(spark, turns):
    frame = turns.select("video_id", F.col("id").cast("int").alias("chunk_id"))
    placed = segments.cluster_by_video(frame, 12).withColumn("part", F.spark_partition_id())
    sizes = placed.groupBy("part").count().collect()
    assert max(r["count"] for r in sizes) < 12_000
    hot = placed.filter("video_id = 'hot'").select("part").distinct().count()
    assert hot >= 6
