"""Which videos still need work: output that exists is not produced again."""

from functools import reduce

from pyspark.sql import DataFrame


def reusable(videos: DataFrame, *done: DataFrame) -> DataFrame:
    """Videos that every output in `done` (each with a video_id column) already holds."""
    return reduce(lambda left, output: left.join(output.select("video_id"), "video_id", "left_semi"), done, videos)


def unprocessed(videos: DataFrame, *done: DataFrame) -> DataFrame:
    """Videos missing from at least one of the outputs `done`. Nothing runs before the result is used."""
    first, *others = done
    return videos.join(reusable(first.select("video_id"), *others), "video_id", "left_anti")
