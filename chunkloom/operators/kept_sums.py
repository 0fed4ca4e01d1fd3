"""Sums of unit vectors that are kept from build to build, so that a mean needs no old vectors.

Each build adds the sums of its new chunks under a name of its own; a build that runs twice
replaces what it wrote, so that no chunk counts twice.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.operators import retrieval

_SCHEMA = "video_id string, size int, n bigint, total array<double>, build string"


def append(chunks: DataFrame, path: str, build: str, embedding: str = "embedding") -> None:
    """Add the sums of new chunks."""
    sums = retrieval.merged_sums(retrieval.vector_sums(chunks, embedding))
    rows = sums.withColumn("video_id", F.col("video_id").cast("string")).withColumn("build", F.lit(build))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("build").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, size, n, total) of all builds."""
    return spark.read.schema(_SCHEMA).parquet(path).drop("build")


def centroids(spark: SparkSession, path: str, videos: DataFrame | None = None) -> DataFrame:
    """The table of `retrieval.centroids` over the chunks of all builds; of `videos` (video_id) only, if given."""
    sums = read(spark, path)
    if videos is not None:
        wanted = videos.select(F.col("video_id").cast("string").alias("_wanted")).distinct()
        sums = sums.join(wanted, F.col("video_id").eqNullSafe(F.col("_wanted")), "left_semi")
    return retrieval.mean_of_sums(sums)
