"""Copy a chunk table to a shared file system and on to a database."""

from pyspark.sql import SparkSession

from chunkloom.sources import database, readers, writers


def export_chunks(
    spark: SparkSession, path: str, uri: str, jdbc: dict | None = None, skip_stored: bool = False
) -> None:
    """Runs the copy and, with `jdbc` options (see `database.write_options`), the append.

    The append reads the copy, so source and database agree even if the source
    changes in between. `skip_stored` leaves out chunks the database already has.
    """
    writers.relocate(spark.read.parquet(path), uri)
    if jdbc is None:
        return
    chunks = readers.read_chunks(spark, uri)
    if skip_stored:
        login = {key: jdbc[key] for key in ("url", "table", "user", "password", "driver") if key in jdbc}
        chunks = database.without_existing(chunks, database.read_table(spark, **login))
    database.append_table(database.to_relational(chunks), **jdbc)
