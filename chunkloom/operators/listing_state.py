"""A listing that is kept up to date: the latest date of each video and title, by month.

Each build adds a row per video and title of its new chunks; older chunks are not read
again. A row that a later one has overtaken stays until `compact`: the latest date is taken on
reading, so that neither it nor a build that runs twice does any harm. Rows lie in a folder
for each month, so that the newest are found in the newest folders. Dates that do not begin like
ISO dates, and missing ones, have a folder of their own, which is always read.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.operators import serving
from chunkloom.session import stored

ODD = "odd"
_SCHEMA = "video_id string, title string, upload_date string, month string"
_MONTH = r"^\d{4}-(0[1-9]|1[0-2])"


def _months(spark: SparkSession, path: str) -> list[str]:
    """The months that have a folder, newest first."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted((n.removeprefix("month=") for n in names if n.startswith("month=") and n != f"month={ODD}"), reverse=True)


def append(chunks: DataFrame, path: str) -> None:
    """Add the latest dates of new chunks (video_id, title, upload_date)."""
    month = F.when(F.rlike("upload_date", F.lit(_MONTH)), F.substring("upload_date", 1, 7)).otherwise(ODD)
    rows = serving.latest_per_title(chunks).withColumn("month", month)
    rows = rows.select(F.col("video_id").cast("string").alias("video_id"), "title", "upload_date", "month")
    rows.repartition("month", F.pmod(F.xxhash64("video_id"), F.lit(8))).sortWithinPartitions("month", F.desc("upload_date")).write.mode("append").partitionBy("month").parquet(path)


def read(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """(video_id, title, upload_date), the latest date of each; of the folders of `months` and the odd dates only, if given."""
    rows = spark.read.schema(_SCHEMA).parquet(path)
    if months is not None:
        rows = rows.filter(F.col("month").isin(*months, ODD))
    return serving.latest_per_title(rows.select(*serving.LISTING))


def newest(spark: SparkSession, path: str, summaries: DataFrame, n: int) -> DataFrame:
    """The n newest rows with a summary, see `serving.newest`.

    Runs jobs: folders are read from the newest on, twice as many each time, until n rows
    are at least as new as the oldest folder read. All others are older then.
    """
    months, count = _months(spark, path), 1
    while count < len(months):
        found = stored(serving.newest(serving.with_summary(read(spark, path, months[:count]), summaries), n), "newest")
        if found.filter(F.col("upload_date") >= months[count - 1]).count() >= n:
            return serving.newest(found, n)
        count *= 2
    return serving.newest(serving.with_summary(read(spark, path), summaries), n)


def compact(spark: SparkSession, path: str, target: str) -> None:
    """The same listing in a new folder, with a row for each video and title."""
    append(read(spark, path), target)
