"""Scans of chunk tables, segment files, listings and image folders."""

import os
import re
from functools import reduce
from pathlib import PurePath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom import schemas
from chunkloom.functions import urls
from chunkloom.sources import writers

_HAS_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.\-]+://")


def clean_path(path: str) -> str:
    """Trimmed, and freed from one pair of quotes around it; local paths are simplified, URIs left alone."""
    text = str(path).strip()
    quoted = re.fullmatch(r"""(["'])(.*)\1""", text, re.DOTALL)
    if quoted:
        text = quoted[2].strip()
    return text if _HAS_SCHEME.match(text) else str(PurePath(text))


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether the file system of the path, which need not be the driver's disk, has a folder there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CHUNKS).parquet(path)


def _json_layouts(spark: SparkSession, path: str) -> dict[bool, list[str]]:
    """The files of a path, by whether they hold JSON arrays. A pass over their lines finds out.

    A file of JSON Lines has no line that begins with a bracket, a file with an array has one.
    """
    opens = F.startswith(F.ltrim("value"), F.lit("["))
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), opens.alias("array"))
    by_layout: dict[bool, list[str]] = {}
    for row in files.groupBy("file").agg(F.max("array").alias("array")).collect():
        by_layout.setdefault(row["array"], []).append(row["file"])
    return by_layout


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON Lines and JSON arrays, told apart file by file. A broken record ends the run."""
    parts = []
    for array, files in sorted(_json_layouts(spark, path).items()):
        reader = spark.read.option("multiLine", array).option("mode", "FAILFAST")
        parts.append((reader.schema(schema) if schema is not None else reader).json(files))
    if not parts:
        return spark.createDataFrame([], schema if schema is not None else T.StructType([]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read_csv(spark: SparkSession, path: str, schema, multi_line: bool) -> DataFrame:
    """A row with too few or too many fields ends the run."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def load_any(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Read a table in the format its path tells: a folder or .parquet is Parquet, else .json or .csv.

    With a `schema`, JSON and CSV are read without a pass over the data to infer it. A CSV
    file without line breaks inside fields can be read by several tasks: `multi_line=False`.
    Broken records raise an error, none is dropped or filled with nulls.
    """
    path = clean_path(path)
    suffix = os.path.splitext(path)[1].lower()
    if suffix == ".parquet" or (_HAS_SCHEME.match(path) and suffix == "") or ("*" not in path and is_folder(spark, path)):
        return spark.read.parquet(path)
    if suffix == ".json":
        return read_json(spark, path, schema)
    if suffix == ".csv":
        return _read_csv(spark, path, schema, multi_line)
    raise ValueError(f"unsupported format: {path}")


def _video_id_of_file() -> Column:
    return F.regexp_extract("_metadata.file_name", r"^(.*)_segments\.json$", 1).alias("video_id")


def _segment_files(reader, folder: str) -> DataFrame:
    text = T.StructField("_corrupt_record", T.StringType())
    names = schemas.SEGMENTS.fieldNames()
    return (
        reader.schema(T.StructType([*schemas.SEGMENTS.fields, text]))
        .option("multiLine", True)
        .option("pathGlobFilter", "*_segments.json")
        .json(folder)
        .select(_video_id_of_file(), *names, F.col("_corrupt_record").isNotNull().alias("broken"))
    )


def read_segment_files(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of all `<video_id>_segments.json` files, each a JSON array.

    Columns: video_id, id, start, end, text, broken. Other keys are ignored. A file that is
    not valid JSON gives a row that is `broken` and otherwise null, after the segments
    before the fault; `plans.build` rejects it.
    """
    return _segment_files(spark.read, folder)


def stream_segment_files(spark: SparkSession, folder: str) -> DataFrame:
    """`read_segment_files` as a stream: each file once, also those added later."""
    return _segment_files(spark.readStream, folder)


_STORED_SEGMENTS = T.StructType([*schemas.SEGMENTS.fields, T.StructField("video_id", T.StringType())])


def stream_segments(spark: SparkSession, path: str) -> DataFrame:
    """`read_segments` as a stream: each file once, also those added later."""
    return spark.readStream.schema(_STORED_SEGMENTS).json(path).select("video_id", *schemas.SEGMENTS.fieldNames())


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments as `writers.write_segments` stores them; video ids stay text."""
    return spark.read.schema(_STORED_SEGMENTS).json(path).select("video_id", *schemas.SEGMENTS.fieldNames())


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Entries (id, title, upload_date) of saved channel listings, JSON objects with an `entries` array."""
    schema = T.StructType([T.StructField("entries", T.ArrayType(schemas.LISTING_ENTRY))])
    listing = spark.read.schema(schema).option("multiLine", True).json(path)
    # A null entry would come out as a row of nulls, which the id filter drops anyway.
    return listing.select(F.inline("entries"))


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, chunk_id, image_path) of all `<folder>/<video_id>/<chunk_id>.jpg`; no content is read."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.jpg")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            F.regexp_extract("path", r"([^/]+)/[^/]+\.jpg$", 1).alias("video_id"),
            F.regexp_extract("path", r"/([^/]+)\.jpg$", 1).try_cast("int").alias("chunk_id"),
        )
        .filter(F.col("chunk_id").isNotNull())
    )
    return found.withColumn("image_path", urls.image_path(folder, F.col("video_id"), F.col("chunk_id")))


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Summary table as `writers.write_summaries` stores it; video ids stay text."""
    return spark.read.schema(schemas.SUMMARIES).parquet(path).select(*schemas.SUMMARIES.fieldNames())


def read_summaries_of(spark: SparkSession, path: str, video_id: str) -> DataFrame:
    """The rows of one video in a summary table: only the bucket of its id is opened.

    Runs no job: the number of buckets is in the names of the folders. A table without buckets is read whole.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    number = writers.held_buckets(status.getPath().getName() for status in listed)
    own = F.col("video_id") == video_id
    if number is None:
        return read_summaries(spark, path).filter(own)
    column = f"{writers._BUCKET}{number}"
    schema = T.StructType([*schemas.SUMMARIES.fields, T.StructField(column, T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path).filter((F.col(column) == writers.bucket(number, F.lit(video_id))) & own)
    return rows.select(*schemas.SUMMARIES.fieldNames())
