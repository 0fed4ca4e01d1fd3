"""Session settings for the command line and the shared scratch location."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, **settings) -> SparkSession:
    """Session with the given settings; whatever else the cluster sets stays as it is.

    Vector sums are kept in a hash map per task. Spark would turn to sorting the
    vectors from the 129th video on; a few thousand sums still fit in memory. A
    join hashes its smaller side where each part of it is small, and need not
    sort the vectors of the other.
    """
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
    }
    for key, value in (defaults | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's checkpoint directory.

    A machine-local temporary folder is used only with a local master, where
    driver and executors share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="chunkloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_stored: list[str] = []


def drop_stored(spark: SparkSession) -> None:
    """Removes the tables that `stored` has written so far; frames that read them end with it."""
    while _stored:
        place = spark._jvm.org.apache.hadoop.fs.Path(_stored.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Runs a job: writes `df` to a scratch folder and reads it back.

    A join with the result knows its true size, so that Spark broadcasts it below
    its threshold and shuffles beyond. It can also split a hot key at run time,
    which it does not on top of another grouping or join by the same key. And a
    lost executor does not bring the work before it back.
    """
    path = scratch_path(df.sparkSession, name)
    _stored.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
