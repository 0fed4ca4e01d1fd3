"""Catch up with segment files that have arrived since the last run."""

from pyspark.sql import DataFrame


def catch_up(segments: DataFrame, path: str, checkpoint: str) -> None:
    """Runs the stream `segments` over all files that are there now, and stops.

    Segments are added to the Parquet table at `path`. The checkpoint remembers the files
    taken: the next run takes new ones only, and a run that was stopped in between
    goes on where it was; the sink's own log keeps what such a run wrote twice out of the table. Read the
    table with `spark.read.parquet(path)`, which follows that log.
    """
    writer = segments.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    query = writer.trigger(availableNow=True).start(path)
    query.awaitTermination()
