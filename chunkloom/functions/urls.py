"""Paths and URLs of videos and frame images."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def image_path(folder: str, video_id: Column, chunk_id: Column) -> Column:
    name = F.concat(chunk_id.cast("string"), F.lit(".jpg"))
    return F.concat(F.lit(folder.rstrip("/") + "/"), video_id, F.lit("/"), name)


def video_url(video_id: Column) -> Column:
    return F.concat(F.lit(fv.SHORT_LINK_PREFIX), video_id)


def query_value(url: Column, key: str) -> Column:
    """Decoded value of the first query parameter named `key`, '' when absent."""
    value = F.regexp_extract(F.regexp_extract(url, _QUERY, 1), rf"(?:^|&)\Q{key}\E=([^&]*)", 1)
    return F.coalesce(F.try_url_decode(value), value)


def url_video_id(url: Column, key: str = fv.VIDEO_QUERY_KEY) -> Column:
    """Video id of a page URL: the path of a short link, else the query parameter."""
    clean = F.btrim(F.coalesce(url, F.lit("")))
    host = F.lower(F.regexp_extract(clean, _HOST, 1))
    by_path = F.regexp_extract(clean, _PATH, 1)
    return (
        F.when(host == "", "")
        .when(F.contains(host, F.lit(fv.SHORT_LINK_HOST)), by_path)
        .otherwise(query_value(clean, key))
    )


def embed_url(url: Column, key: str = fv.VIDEO_QUERY_KEY) -> Column:
    """Player URL for a page URL, '' when it names no video."""
    video = url_video_id(url, key)
    return F.when(video == "", "").otherwise(F.concat(F.lit(fv.EMBED_PREFIX), video))
