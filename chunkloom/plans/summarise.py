"""Summaries of the videos in a chunk table."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv
from chunkloom import schemas
from chunkloom.operators import kept_sums, pending, retrieval
from chunkloom.operators.summaries import drafts, finish, summarise
from chunkloom.session import stored


class Summarised(NamedTuple):
    summaries: DataFrame
    rejects: DataFrame


def summarise_videos(
    chunks: DataFrame,
    top_k: int = fv.TOP_K,
    model=None,
    table: DataFrame | None = None,
    tasks: int | None = None,
    done: DataFrame | None = None,
    **prompt,
) -> Summarised:
    """Summaries (video_id, summary_text, video_url), one row per video, and rejects.

    Each video is in one of the two results: rejects (video_id, reject_reason) hold the
    videos whose vectors differ in size, and those whose prompt the model fails on. Videos in
    `done` are left out. With a model, this runs a job that stores what it returns.

    `chunks` needs video_id, chunk_id and text, and may hold a vector column
    named embedding, emb, vector or embeddings. With one, and no `table` of
    centroids given, this runs the job of `retrieval.stored_centroids`. For `model`,
    `tasks` and `prompt` see `operators.summaries.summarise`.
    """
    schemas.require_columns(chunks, fv.REQUIRED_COLUMNS)
    embedding = schemas.first_present(chunks, fv.EMBEDDING_NAMES)
    if done is not None:
        chunks = pending.unprocessed(chunks, done)
    if embedding is not None and table is None:
        table = retrieval.stored_centroids(chunks, embedding)
    picked = retrieval.top_chunks(chunks, top_k, embedding, table)
    if embedding is None:
        rejects = chunks.select("video_id").filter(F.lit(False))
    else:
        rejects = retrieval.vector_rejects(table).select("video_id")
    rejects = rejects.withColumn("reject_reason", F.lit("vectors differ in size"))
    if model is None:
        return Summarised(summarise(retrieval.contexts(picked)), rejects)
    drafted = stored(drafts(retrieval.contexts(picked), model, tasks, **prompt), "drafts")
    failed = drafted.filter("error is not null").select("video_id", F.concat(F.lit("model failed: "), "error").alias("reject_reason"))
    return Summarised(finish(drafted.filter("error is null")), rejects.unionByName(failed))


def summarise_changed(
    spark: SparkSession, chunks: DataFrame, new_chunks: DataFrame, sums: str, build: str, top_k: int = fv.TOP_K, model=None, **options
) -> Summarised:
    """`summarise_videos` for the videos that have new chunks, over all of their chunks.

    The sums kept in the folder `sums` give the means: vectors of other videos are not read, and
    those of the new chunks once, under the name `build`; see `kept_sums`.
    """
    embedding = schemas.first_present(new_chunks, fv.EMBEDDING_NAMES)
    if embedding is None:
        raise ValueError("no vector column")
    kept_sums.append(new_chunks, sums, build, embedding)
    changed = stored(new_chunks.select(F.col("video_id").alias("_changed")).distinct(), "changed")
    table = stored(kept_sums.centroids(spark, sums, changed.select(F.col("_changed").alias("video_id"))), "centroids")
    own = chunks.join(changed, F.col("video_id").eqNullSafe(F.col("_changed")), "left_semi")
    return summarise_videos(own, top_k, model, table, **options)
