"""Listing queries.

lineitem rows stand for segments of the video l_partkey, uploaded on l_shipdate;
part holds the titles; parts up to size 25 have a summary.
"""

from functools import reduce

from pyspark.sql import functions as F

from chunkloom.functions import dates
from chunkloom.operators import segments, serving
from chunkloom.plans import listings
from chunkloom.session import scratch_path
from querybook.tables import iso, read

_AS_OF = "1998-09-02"


def _chunks(spark, folder):
    lines = read(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("video_id"), iso("l_shipdate").alias("upload_date")
    )
    titles = read(spark, folder, "part").select(F.col("p_partkey").alias("video_id"), F.col("p_name").alias("title"))
    return segments.attach_videos(lines, titles)


def _summaries(spark, folder):
    part = read(spark, folder, "part").filter("p_size <= 25")
    return part.select(
        F.col("p_partkey").alias("video_id"),
        F.col("p_name").alias("summary_text"),
        F.concat(F.lit("https://youtu.be/"), F.col("p_partkey").cast("string")).alias("video_url"),
    )


def catalogue_latest(spark, folder):
    return listings.catalogue(_chunks(spark, folder), _summaries(spark, folder))


def title_search(spark, folder):
    return listings.search(_chunks(spark, folder), _summaries(spark, folder), "red")


def title_search_wildcard(spark, folder):
    return listings.search(_chunks(spark, folder), _summaries(spark, folder), "_d%g", n=40)


def title_search_escape(spark, folder):
    """An escaped pair of backslashes, then a letter that is not in any title; another pair before a wildcard."""
    chunks = _chunks(spark, folder).withColumn("title", F.concat("title", F.lit("\\x%")))
    summaries = _summaries(spark, folder)
    found = listings.search(chunks, summaries, "\\\\x", n=30)
    return found.unionByName(listings.search(chunks, summaries, "red%\\\\x\\%", n=10)).unionByName(listings.search(chunks, summaries, "\\%x"))


def title_search_ignore_case(spark, folder):
    return listings.search(_chunks(spark, folder), _summaries(spark, folder), "RED", collation="UTF8_LCASE")


def _document_titles(spark, folder):
    """Documents as videos: the first letters as title, some with a percent sign and a backslash; dates from the length."""
    key, text = F.col("doc_id"), F.col("text")
    title = F.when(key % 5 == 0, F.concat(F.substring(text, 1, 25), F.lit("100% \\ "), F.substring(text, 26, 25))).otherwise(F.substring(text, 1, 50))
    date = F.date_add(F.to_date(F.lit("2020-01-01")), (F.col("n_chars") % 900).cast("int")).cast("string")
    return read(spark, folder, "documents").select(key.cast("string").alias("video_id"), title.alias("title"), date.alias("upload_date"))


_ACCENTED = [("ÉTE", 40), ("%cion_%É", 40), ("ü_e%é", 40), ("100\\% \\\\%a", 40), ("ÊTRÈ%\\l", 40)]


def title_search_accents(spark, folder):
    """Wildcards and escapes in searches without case and accents."""
    chunks = _document_titles(spark, folder)
    found = [listings.search(chunks, chunks.select("video_id"), q, n, "UNICODE_CI_AI").withColumn("q", F.lit(q)) for q, n in _ACCENTED]
    return reduce(lambda a, b: a.unionByName(b), found)


def _kept(spark, folder, chunks, parts=2):
    """Folders of a listing and an index that are brought up to date with the chunks in parts."""
    state, index = scratch_path(spark, "listing"), scratch_path(spark, "title-index")
    for part in range(parts):
        listings.keep_listing(chunks.filter(F.pmod(F.xxhash64("video_id", "upload_date"), F.lit(parts)) == part), state, index)
    return state, index


def catalogue_incremental(spark, folder):
    """The catalogue kept in two builds, which split the chunks of most videos."""
    state, _ = _kept(spark, folder, _chunks(spark, folder))
    return listings.kept_catalogue(spark, state, _summaries(spark, folder))


def title_search_indexed(spark, folder):
    """The searches of the four queries above and of accents, through the index."""
    summaries = _summaries(spark, folder)
    state, index = _kept(spark, folder, _chunks(spark, folder))
    asked = [("red", 24, None), ("_d%g", 40, None), ("RED", 24, "UTF8_LCASE")]
    found = [listings.kept_search(spark, state, index, summaries, q, n, c).withColumn("q", F.lit(q)) for q, n, c in asked]
    state, index = _kept(spark, folder, _chunks(spark, folder).withColumn("title", F.concat("title", F.lit("\\x%"))), 1)
    asked = [("\\\\x", 30), ("red%\\\\x\\%", 10), ("\\%x", 24)]
    found += [listings.kept_search(spark, state, index, summaries, q, n).withColumn("q", F.lit(q)) for q, n in asked]
    documents = _document_titles(spark, folder)
    state, index = _kept(spark, folder, documents)
    found += [
        listings.kept_search(spark, state, index, documents.select("video_id"), q, n, "UNICODE_CI_AI").withColumn("q", F.lit(q)) for q, n in _ACCENTED
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


def recent_items(spark, folder):
    return listings.recent(_chunks(spark, folder), _summaries(spark, folder), _AS_OF)


def recent_by_day(spark, folder):
    lines = read(spark, folder, "lineitem").select(iso("l_shipdate").alias("upload_date"))
    recent = dates.since(F.col("upload_date"), F.to_date(F.lit(_AS_OF)))
    return lines.groupBy("upload_date").agg(F.count("*").alias("lines")).withColumn("recent", recent)


def listing_distinct(spark, folder):
    return serving.distinct_listing(_chunks(spark, folder))


def latest_per_title(spark, folder):
    """Orders as chunks of their customer, the priority as title: many titles per video, null dates."""
    orders = read(spark, folder, "orders").select(
        F.col("o_custkey").alias("video_id"),
        F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_custkey") % 4 != 0, iso("o_orderdate")).alias("upload_date"),
    )
    return serving.latest_per_title(orders)


def summary_lookup(spark, folder):
    return listings.summary_of(_summaries(spark, folder), "70")


def summary_lookup_missing(spark, folder):
    return listings.summary_of(_summaries(spark, folder), "-1")


_SQL_CHUNKS = """
  select l_partkey as video_id, p_name as title, strftime(l_shipdate, '%Y-%m-%d') as upload_date
  from lineitem join part on l_partkey = p_partkey"""
_SQL_SUMMARISED = "video_id in (select p_partkey from part where p_size <= 25)"


def _sql_catalogue(where="true", n=24):
    return f"""
  select video_id, title, max(upload_date) as upload_date from ({_SQL_CHUNKS})
  where {_SQL_SUMMARISED} and {where}
  group by video_id, title order by upload_date desc, video_id, title limit {n}"""


_SQL_LOOKUP = """
  select p_name as summary_text, 'https://youtu.be/' || p_partkey as video_url,
         'https://www.youtube.com/embed/' || p_partkey as embed_url
  from part where p_size <= 25 and p_partkey = {key} limit 1"""

_SQL_DOCUMENT_TITLES = r"""
  select cast(doc_id as varchar) as video_id,
         case when doc_id % 5 = 0 then substr(text, 1, 25) || '100% \ ' || substr(text, 26, 25) else substr(text, 1, 50) end as title,
         strftime(date '2020-01-01' + cast(n_chars % 900 as integer), '%Y-%m-%d') as upload_date
  from documents"""


def _sql_accented(q, n, pattern):
    quoted = q.replace("'", "''")
    return f"""
  select * from (
    select video_id, title, upload_date, '{quoted}' as q from ({_SQL_DOCUMENT_TITLES})
    where lower(strip_accents(title)) like lower(strip_accents('{pattern}')) escape '!'
    order by upload_date desc, video_id, title limit {n})"""


_SQL_ACCENTED = " union all ".join(
    _sql_accented(q, n, pattern)
    for (q, n), pattern in zip(_ACCENTED, ["%ÉTE%", "%cion_%É%", "%ü_e%é%", "%100!% \\%a%", "%ÊTRÈ%l%"])
)


def _sql_indexed(q, where, n, title="title"):
    return f"""
  select * from (
    select cast(video_id as varchar) as video_id, {title} as title, max(upload_date) as upload_date, '{q}' as q from ({_SQL_CHUNKS})
    where {_SQL_SUMMARISED} and {where} group by video_id, title
    order by upload_date desc, cast(video_id as varchar), title limit {n})"""


_SQL_INDEXED = " union all ".join(
    [
        _sql_indexed("red", "title like '%red%'", 24),
        _sql_indexed("_d%g", "title like '%_d%g%'", 40),
        _sql_indexed("RED", "title ilike '%RED%'", 24),
        _sql_indexed("\\\\x", "true", 30, "title || '\\x%'"),
        _sql_indexed("red%\\\\x\\%", "title like '%red%'", 10, "title || '\\x%'"),
        _SQL_ACCENTED,
    ]
)

PAIRS = {
    "catalogue_latest": (catalogue_latest, _sql_catalogue()),
    "title_search": (title_search, _sql_catalogue("title like '%red%'")),
    "title_search_wildcard": (title_search_wildcard, _sql_catalogue("title like '%_d%g%'", 40)),
    "title_search_escape": (
        title_search_escape,
        " union all ".join(
            f"select * replace (title || '\\x%' as title) from ({_sql_catalogue(where, n)})"
            for where, n in (("true", 30), ("title like '%red%'", 10))
        ),
    ),
    "title_search_ignore_case": (title_search_ignore_case, _sql_catalogue("title ilike '%RED%'")),
    "title_search_accents": (title_search_accents, _SQL_ACCENTED),
    "title_search_indexed": (title_search_indexed, _SQL_INDEXED),
    "catalogue_incremental": (
        catalogue_incremental,
        f"""
  select cast(video_id as varchar) as video_id, title, max(upload_date) as upload_date from ({_SQL_CHUNKS})
  where {_SQL_SUMMARISED} group by video_id, title order by upload_date desc, cast(video_id as varchar), title limit 24""",
    ),
    "recent_items": (
        recent_items,
        f"""
  select distinct video_id, title, upload_date from ({_SQL_CHUNKS})
  where {_SQL_SUMMARISED} and cast(upload_date as date) >= date '{_AS_OF}' - 7
  order by upload_date desc, video_id, title limit 8""",
    ),
    "recent_by_day": (
        recent_by_day,
        f"""
  select strftime(l_shipdate, '%Y-%m-%d') as upload_date, count(*) as lines,
         cast(l_shipdate as date) >= date '{_AS_OF}' - 7 as recent
  from lineitem group by all""",
    ),
    "listing_distinct": (listing_distinct, f"select distinct video_id, title, upload_date from ({_SQL_CHUNKS})"),
    "latest_per_title": (
        latest_per_title,
        """
  select o_custkey as video_id, o_orderpriority as title,
         max(case when o_custkey % 4 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end) as upload_date
  from orders group by 1, 2""",
    ),
    "summary_lookup": (summary_lookup, _SQL_LOOKUP.format(key=70)),
    "summary_lookup_missing": (summary_lookup_missing, _SQL_LOOKUP.format(key=-1)),
}
