"""Video metadata: clean the listing, repair dates and titles from other sources."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv
from chunkloom.functions import dates
from chunkloom.session import stored

# More than there are days that a date can have.
_SPAN = 1 << 33


def clean_listing(entries: DataFrame) -> DataFrame:
    """Listing entries (id, title, upload_date 'YYYYMMDD') to (video_id, title, upload_date ISO).

    Entries without an id are dropped, a missing title becomes ''.
    """
    return entries.filter("id is not null and id <> ''").select(
        F.col("id").alias("video_id"),
        F.coalesce("title", F.lit("")).alias("title"),
        dates.parse_compact_date(F.col("upload_date")).alias("upload_date"),
    )


def _dated(source: DataFrame, rank: int) -> DataFrame:
    """(video_id, order, title) of the dates, ISO or compact, of a source; no order where one cannot be parsed.

    The order rises with the date, in whole days; all of the first source is above all of the second.
    """
    text = F.col("upload_date").cast("string")
    # ISO dates need no look at the pattern of compact ones.
    iso = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-")
    date = F.when(iso, F.try_to_date(text)).otherwise(F.coalesce(F.try_to_date(dates.parse_compact_date(text)), F.try_to_date(text)))
    dated = source.filter(F.col("upload_date").isNotNull())
    return dated.select("video_id", (F.unix_date(date).cast("bigint") - F.lit(rank * _SPAN)).alias("order"), "title")


def _found(needy: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """(video_id, date, title) from the first source with a date; the latest where it has several.

    Runs a job that reads both sources once and keeps their different rows: a hot video sends
    each day once per task. Days are compared as numbers and titles gathered for the latest day only, so that
    nothing has to be sorted.
    """
    rows = stored(_dated(first, 0).unionByName(_dated(second, 1)).filter(F.col("order").isNotNull()).distinct(), "dated")
    latest = rows.join(needy, "video_id", "left_semi").groupBy("video_id").agg(F.max("order").alias("order"))
    titles = rows.join(latest, ["video_id", "order"]).groupBy("video_id", "order").agg(F.array_max(F.collect_set("title")).alias("title"))
    day = F.when(F.col("order") < -_SPAN // 2, F.col("order") + _SPAN).otherwise(F.col("order")).cast("int")
    return titles.select("video_id", F.struct(F.date_from_unix_date(day).cast("string").alias("upload_date"), "title").alias("source"))


def repair(videos: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Fill missing or sentinel dates from `first`, failing that from `second`.

    All three frames hold (video_id, title, upload_date); the sources' dates may be
    'YYYYMMDD' or ISO, and one that cannot be parsed counts as missing. A source's
    title is taken only along with its date and only where the video has none. With
    no date anywhere the old values stay. Runs jobs that bring the sources
    together, so that the join with the videos can split a listing that repeats one.
    """
    own = F.col("upload_date")
    needed = own.isNull() | (own == fv.SENTINEL_DATE)
    needy = videos.filter(needed).select("video_id").distinct()
    joined = videos.join(stored(_found(needy, first, second), "found"), "video_id", "left")
    source = F.when(needed, F.col("source"))
    return joined.select(
        "video_id",
        F.coalesce(F.nullif("title", F.lit("")), source["title"], F.lit("")).alias("title"),
        F.coalesce(source["upload_date"], own).alias("upload_date"),
    )


def count_videos(videos: DataFrame) -> DataFrame:
    return videos.agg(F.count("*").alias("videos"))
