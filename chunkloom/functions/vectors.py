"""Vectors held as arrays or as JSON text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_json_text(vector: Column) -> Column:
    return F.to_json(vector)


def as_array(df: DataFrame, name: str) -> Column:
    """The vector column as a numeric array, whatever type it is stored in; null when it is none."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.from_json(F.col(name), "array<double>")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        narrow = isinstance(kind.elementType, (T.FloatType, T.DoubleType))
        return F.col(name) if narrow else F.col(name).cast("array<double>")
    return F.lit(None).cast("array<double>")
