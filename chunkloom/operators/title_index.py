"""An inverted index of titles by runs of three letters.

The index holds, for each run of letters in a title without case and accents, the titles
with it, sorted by run and dealt to folders by it; a frequent run spans several row groups. A search
opens the folders of the runs that it needs, keeps the titles that have all of them, and verifies these. A search
without three letters in a row reads the list of titles, which is kept beside the runs.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions import folding
from chunkloom.operators import serving
from chunkloom.session import stored

LETTERS = 3
BUCKETS = 64
_TITLES = "video_id string, title string"
_RUNS = "run string, video_id string, title string, bucket int"


def _bucket(run: Column) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(BUCKETS)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def titles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_TITLES).parquet(f"{path}/titles")


def append(chunks: DataFrame, path: str) -> None:
    """Add the titles of chunks (video_id, title) that the index lacks."""
    spark = chunks.sparkSession
    new = chunks.select(F.col("video_id").cast("string").alias("video_id"), "title").filter("title is not null").distinct()
    if _exists(spark, f"{path}/titles"):
        new = new.exceptAll(titles(spark, path).distinct().join(new, ["video_id", "title"], "left_semi"))
    new = stored(new, "titles")
    runs = F.array_distinct(F.regexp_extract_all(folding.fold(F.col("title")), F.lit(f"(?s)(?=(.{{{LETTERS}}}))"), F.lit(1)))
    posted = new.select(F.explode(runs).alias("run"), "video_id", "title").withColumn("bucket", _bucket(F.col("run")))
    posted.repartition("bucket").sortWithinPartitions("bucket", "run").write.mode("append").partitionBy("bucket").parquet(f"{path}/runs")
    # Last, so that a stop in between is mended by the next call; a row twice does no harm.
    new.write.mode("append").parquet(f"{path}/titles")


def runs_of(q: str) -> list[str]:
    """The runs that every title found by q has."""
    pieces = [folding.fold_literal(p) for p in serving.literal_pieces(q)]
    return sorted({p[i : i + LETTERS] for p in pieces for i in range(len(p) - LETTERS + 1)})


def matching(spark: SparkSession, path: str, q: str, collation: str | None = None) -> DataFrame:
    """(video_id, title) of the titles that contain q, see `serving.title_matches`."""
    needed = runs_of(q)
    if not needed:
        found = titles(spark, path).distinct()
    else:
        rows = spark.read.schema(_RUNS).parquet(f"{path}/runs")
        rows = rows.filter(F.col("bucket").isin(*[_bucket(F.lit(r)) for r in needed]) & F.col("run").isin(*needed))
        counted = rows.groupBy("video_id", "title").agg(F.count_distinct("run").alias("runs"))
        found = counted.filter(F.col("runs") == len(needed)).select("video_id", "title")
    return found.filter(serving.title_matches(F.col("title"), q, collation))
