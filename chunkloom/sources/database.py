"""Relational tables over JDBC. Addresses and credentials come from the caller only."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv
from chunkloom import schemas
from chunkloom.functions import vectors


def to_relational(chunks: DataFrame) -> DataFrame:
    """Chunk columns in table order, the embedding as JSON text."""
    names = schemas.CHUNKS.fieldNames()
    return chunks.withColumn("embedding", vectors.to_json_text(F.col("embedding"))).select(*names)


def without_existing(chunks: DataFrame, stored: DataFrame) -> DataFrame:
    """Chunks whose key is not stored yet, so that a rerun adds no second copy."""
    return chunks.join(stored.select("video_id", "chunk_id"), ["video_id", "chunk_id"], "left_anti")


def _connection(url: str, table: str, user: str | None, password: str | None, driver: str | None) -> dict:
    given = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    return {key: value for key, value in given.items() if value is not None}


def write_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batch_size: int = fv.JDBC_BATCH_SIZE,
    isolation: str = "READ_COMMITTED",
    connections: int | None = None,
) -> dict:
    options = _connection(url, table, user, password, driver)
    options |= {"batchsize": str(batch_size), "isolationLevel": isolation}
    if connections is not None:
        options["numPartitions"] = str(connections)
    return options


def append_table(df: DataFrame, url: str, table: str, **options) -> None:
    """Append rows; `options` as in `write_options`.

    Each task is one transaction, so a task that fails half-way and is run again
    leaves no rows twice. Isolation 'NONE' does without: it is faster, but not
    safe when executors are lost. `connections` bounds the open connections.
    """
    df.write.format("jdbc").options(**write_options(url, table, **options)).mode("append").save()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A table as a DataFrame; filters and column choices are sent to the database.

    `split` is (numeric column, lowest, highest, number of parallel reads);
    without it one task reads the whole table.
    """
    reader = spark.read.format("jdbc").options(**_connection(url, table, user, password, driver))
    if split is not None:
        column, low, high, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()
