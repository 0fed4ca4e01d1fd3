"""Explicit schemas of the tables the library reads and writes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNKS = T.StructType(
    [
        T.StructField("video_id", T.StringType(), False),
        T.StructField("title", T.StringType(), True),
        T.StructField("upload_date", T.StringType(), True),
        T.StructField("chunk_id", T.IntegerType(), False),
        T.StructField("start_time", T.StringType(), True),
        T.StructField("end_time", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("embedding", T.ArrayType(T.DoubleType()), True),
        T.StructField("image_path", T.StringType(), True),
    ]
)

SUMMARIES = T.StructType(
    [
        T.StructField("video_id", T.StringType(), True),
        T.StructField("summary_text", T.StringType(), True),
        T.StructField("video_url", T.StringType(), True),
    ]
)

# Times and ids are read as text so that a bad value ends up in the rejects, not in an exception.
SEGMENTS = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("start", T.StringType(), True),
        T.StructField("end", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)

LISTING_ENTRY = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("upload_date", T.StringType(), True),
    ]
)


def _typed(field: T.StructField) -> Column:
    return F.col(field.name).cast(field.dataType).alias(field.name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the columns of `schema`, in its order and with its types."""
    return df.select(*[_typed(field) for field in schema.fields])


def require_columns(df: DataFrame, names) -> None:
    """Fail before any job runs when a needed column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def first_present(df: DataFrame, names) -> str | None:
    """First of `names` that is a column of `df`."""
    return next((name for name in names if name in df.columns), None)
