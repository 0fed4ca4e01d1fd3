"""Sinks for segments, chunk tables and summaries."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom import schemas
from chunkloom.session import stored

BUCKETS = 64
_BUCKET = "bucket_of_"


def bucket(number: int, video_id) -> Column:
    """The bucket of a video in a table of so many."""
    return F.pmod(F.xxhash64(video_id), F.lit(number)).cast("int")


def held_buckets(names) -> int | None:
    """The number of buckets of a table, from the names of its columns or folders."""
    held = [int(name.removeprefix(_BUCKET).partition("=")[0]) for name in names if name.startswith(_BUCKET)]
    return held[0] if held else None


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def write_segments(segments: DataFrame, path: str) -> None:
    """Append segments as UTF-8 JSON Lines, with videos dealt to buckets, one folder each.

    A store that has a folder for each video keeps them. Pass only videos without segments
    yet, see `pending.unprocessed`.
    """
    rows = segments.select("video_id", *schemas.SEGMENTS.fieldNames())
    names = _folders(segments.sparkSession, path)
    if any(name.startswith("video_id=") for name in names):
        rows.write.mode("append").partitionBy("video_id").json(path)
        return
    number = held_buckets(names) or BUCKETS
    column = f"{_BUCKET}{number}"
    # A long video goes to several tasks.
    dealt = rows.withColumn(column, bucket(number, "video_id")).repartition(column, F.pmod(F.xxhash64("id"), F.lit(8)))
    dealt.write.mode("append").partitionBy(column).json(path)


def write_chunks(chunks: DataFrame, path: str, keep: bool = False) -> None:
    """Replace the chunk table, or with `keep` add to it: pass only videos that it lacks then."""
    schemas.conform(chunks, schemas.CHUNKS).write.mode("append" if keep else "overwrite").parquet(path)


def relocate(source: DataFrame, uri: str) -> None:
    """Copy a dataset as it is to another place, replacing what is there."""
    source.write.mode("overwrite").parquet(uri)


def stored_summaries(spark: SparkSession, path: str) -> DataFrame | None:
    """The summary table with its bucket column, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def write_summaries(summaries: DataFrame, path: str, buckets: int | None = None) -> None:
    """Store summaries so that a rerun replaces the videos it holds and leaves the others.

    Videos are dealt to buckets, one folder each. The number of buckets is part of the
    column name; a table keeps the number that it was first written with, whatever is
    asked for later. A rerun rewrites the buckets it touches, from their other rows and
    the new ones. Null and empty ids are kept apart.
    """
    fresh = schemas.conform(summaries, schemas.SUMMARIES)
    existing = stored_summaries(fresh.sparkSession, path)
    number = buckets or BUCKETS
    if existing is not None:
        number = held_buckets(existing.columns)
        if number is None:
            raise ValueError(f"not a table of bucketed summaries: {path}")
    column = f"{_BUCKET}{number}"
    fresh = fresh.withColumn(column, bucket(number, "video_id"))
    rows = fresh
    if existing is not None:
        # The new rows are used three times; kept in a table, no summary is made twice.
        fresh = stored(fresh, "summaries")
        touched = fresh.select(column).distinct()
        others = existing.join(F.broadcast(touched), column, "left_semi").join(
            fresh.select(F.col("video_id").alias("_new")),
            F.col("video_id").eqNullSafe(F.col("_new")),
            "left_anti",
        )
        rows = fresh.unionByName(others)
    # Sorted, so that a lookup by id skips most of each file, and with a filter that tells which ids it lacks.
    sorted_rows = rows.repartition(column).sortWithinPartitions(column, "video_id")
    writer = sorted_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("parquet.bloom.filter.enabled#video_id", "true").partitionBy(column).parquet(path)
