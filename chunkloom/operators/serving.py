"""Building blocks of the listing queries."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions import folding

LISTING = ("video_id", "title", "upload_date")


def distinct_listing(chunks: DataFrame) -> DataFrame:
    return chunks.select(*LISTING).distinct()


def latest_per_title(chunks: DataFrame) -> DataFrame:
    """Largest date text per video and title; a video with two titles gives two rows.

    Full ISO dates sort like their text, so their maximum is taken over dates: over
    text, Spark would have to sort the chunks before grouping them. Other texts are
    gathered as a set, which holds few for a video.
    """
    own = F.col("upload_date")
    date = F.try_to_date(own)
    iso = F.coalesce(date.cast("string") == own, F.lit(False))
    gathered = chunks.groupBy("video_id", "title").agg(F.max(F.when(iso, date)).alias("_date"), F.collect_set(F.when(~iso, own)).alias("_odd"))
    largest = F.array_max(F.concat("_odd", F.array_compact(F.array(F.col("_date").cast("string")))))
    return gathered.select("video_id", "title", largest.alias("upload_date"))


def with_summary(listing: DataFrame, summaries: DataFrame) -> DataFrame:
    """Rows whose video has a summary.

    No summary column is shown, so a semi join stands for the inner join and its
    grouping. It is written above the aggregation: a summary list that can be
    broadcast is pushed below it by the optimizer, a larger one then meets the
    few grouped rows and not the chunks.
    """
    return listing.join(summaries.select("video_id"), "video_id", "left_semi")


def newest(listing: DataFrame, n: int) -> DataFrame:
    """The n newest rows; equal dates are ordered by video and title."""
    return listing.select(*LISTING).orderBy(F.col("upload_date").desc(), "video_id", "title").limit(n)


def _like_pattern(q: str) -> str:
    """'%q%' in which a backslash before an ordinary character is dropped, as the database does."""
    pattern = re.sub(r"\\(.)", lambda pair: pair[0] if pair[1] in "%_\\" else pair[1], q, flags=re.DOTALL)
    return f"%{pattern}%"


def title_matches(title: Column, q: str, collation: str | None = None) -> Column:
    """Titles containing q, in which % and _ are wildcards.

    `collation` tells what is ignored: 'UTF8_LCASE' case, in Spark's collation of that name;
    'UNICODE_CI_AI' case and accents, letter by letter, as the wildcards of a database do.
    """
    if collation is None:
        return title.like(_like_pattern(q))
    if collation == "UTF8_LCASE":
        return F.collate(title, collation).like(_like_pattern(q))
    if collation == "UNICODE_CI_AI":
        return folding.fold(title).like(_like_pattern(folding.fold_literal(q)))
    raise ValueError(f"titles cannot be searched in the collation {collation}")


def literal_pieces(q: str) -> list[str]:
    """The texts between the wildcards of q, in order."""
    pieces = [""]
    for escaped, letter in re.findall(r"(\\?)(.)", q, flags=re.DOTALL):
        if letter in "%_" and not escaped:
            pieces.append("")
        else:
            pieces[-1] += letter
    return [p for p in pieces if p]


def first_by_id(table: DataFrame, video_id: str) -> DataFrame:
    """The first row of a video; no row means not found."""
    return table.filter(F.col("video_id") == video_id).limit(1)
