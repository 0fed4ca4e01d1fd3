"""Chunk table from video listing, segments and images."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom import schemas
from chunkloom.operators import metadata, pending, segments as seg
from chunkloom.operators.embedding import embed, embed_guarded
from chunkloom.session import stored


class Built(NamedTuple):
    chunks: DataFrame
    rejects: DataFrame


def build_chunks(
    entries: DataFrame,
    segments: DataFrame,
    images: DataFrame,
    phrases=(),
    first_source: DataFrame | None = None,
    second_source: DataFrame | None = None,
    image_folder: str = "chunk_images",
    model=None,
    partitions: int | None = None,
    done: DataFrame | None = None,
    with_rejects: bool = True,
) -> Built:
    """Chunk table and rejected segments, among them files that could not be read and texts that the model fails on.

    entries: id, title, upload_date 'YYYYMMDD'; segments: video_id, id, start,
    end, text; images: video_id, chunk_id. The sources (video_id, title,
    upload_date ISO) repair missing dates. Rows are filtered while they are
    still narrow: blank and stop-phrase texts go before any join, vectors are
    computed last, after the final shuffle, in `partitions` tasks if given. Videos in
    `done` are left out. Runs a job for the videos, one that types the segments, and with a
    model one that embeds the chunks, all kept as tables: the segments are read once, for
    chunks and rejects, and the model sees each text once. Without `with_rejects` the typed
    segments are not kept; rejects that are asked for all the same read them anew.
    """
    videos = metadata.clean_listing(entries)
    if first_source is not None or second_source is not None:
        nothing = videos.filter(F.lit(False))
        videos = metadata.repair(videos, first_source or nothing, second_source or nothing)
    if done is not None:
        videos = pending.unprocessed(videos, done)
    videos = stored(videos, "videos")
    if done is not None:
        segments = segments.join(videos.select("video_id"), "video_id", "left_semi")
    kept = seg.drop_stop_phrases(seg.strip_and_drop_blank(segments), phrases)
    typed = seg.type_columns(kept)
    typed = stored(typed, "typed") if with_rejects else typed
    joined = seg.attach_videos(seg.accepted(typed), videos)
    chunks = seg.attach_images(seg.derive_times(joined), images, image_folder)
    chunks = seg.cluster_by_video(chunks, partitions)
    # Segments of unknown videos go without notice, files that cannot be read do not.
    rejects = seg.rejected(typed)
    unread = F.col("reject_reason") == seg.UNREAD
    known = rejects.filter(~unread).join(videos.select("video_id"), "video_id", "left_semi")
    rejects = known.unionByName(rejects.filter(unread))
    if model is None:
        return Built(schemas.conform(embed(chunks), schemas.CHUNKS), rejects)
    tried = stored(embed_guarded(chunks, model), "embedded")
    failed = tried.filter("model_error is not null").select(
        "video_id",
        *[F.col(own).cast("string").alias(name) for own, name in (("chunk_id", "id"), ("start_s", "start"), ("end_s", "end"))],
        "text",
        F.concat(F.lit("model failed: "), "model_error").alias("reject_reason"),
    )
    return Built(schemas.conform(tried.filter("model_error is null"), schemas.CHUNKS), rejects.unionByName(failed))
