"""Listing queries over a chunk table and a summary table."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv
from chunkloom.functions import dates, urls
from chunkloom.operators import listing_state, serving, title_index
from chunkloom.session import stored


def recent(
    chunks: DataFrame,
    summaries: DataFrame,
    as_of: datetime.date | str | None = None,
    n: int = fv.RECENT_LIMIT,
) -> DataFrame:
    """Newest summarised videos of the last seven days before `as_of` (today by default)."""
    day = F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))
    fresh = chunks.filter(dates.since(F.col("upload_date"), day))
    return serving.newest(serving.with_summary(serving.distinct_listing(fresh), summaries), n)


def catalogue(chunks: DataFrame, summaries: DataFrame, n: int = fv.CATALOGUE_LIMIT) -> DataFrame:
    """Newest summarised videos."""
    listing = serving.latest_per_title(chunks)
    return serving.newest(serving.with_summary(listing, summaries), n)


def search(
    chunks: DataFrame,
    summaries: DataFrame,
    q: str,
    n: int = fv.CATALOGUE_LIMIT,
    collation: str | None = None,
) -> DataFrame:
    """Newest summarised videos whose title contains q; all of them when q is empty."""
    if q:
        chunks = chunks.filter(serving.title_matches(F.col("title"), q, collation))
    return catalogue(chunks, summaries, n)


def keep_listing(new_chunks: DataFrame, state: str, index: str) -> None:
    """Bring the kept listing and the index of titles up to date with new chunks, which are all that is read of the chunks, once."""
    listing = stored(serving.latest_per_title(new_chunks), "new-listing")
    listing_state.append(listing, state)
    title_index.append(listing, index)


def kept_catalogue(spark: SparkSession, state: str, summaries: DataFrame, n: int = fv.CATALOGUE_LIMIT) -> DataFrame:
    """`catalogue` from the kept listing: reads its newest months, and no chunks."""
    return listing_state.newest(spark, state, summaries, n)


def kept_search(
    spark: SparkSession, state: str, index: str, summaries: DataFrame, q: str, n: int = fv.CATALOGUE_LIMIT, collation: str | None = None
) -> DataFrame:
    """`search` from the kept listing and the index of titles: reads the parts of the index that q needs, and no chunks."""
    if not q:
        return kept_catalogue(spark, state, summaries, n)
    found = title_index.matching(spark, index, q, collation)
    listing = listing_state.read(spark, state).join(found, ["video_id", "title"], "left_semi")
    return serving.newest(serving.with_summary(listing, summaries), n)


def summary_of(summaries: DataFrame, video_id: str) -> DataFrame:
    """Summary, page URL and player URL of one video; no row when it has no summary."""
    return serving.first_by_id(summaries, video_id).select(
        "summary_text", "video_url", urls.embed_url(F.col("video_url")).alias("embed_url")
    )
