"""From listing and segments to the chunk table.

orders stand for a video listing, lineitem and customer for the two sources of
missing dates, conversations for segments, labels for finished work.
"""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from chunkloom.operators import embedding, metadata, pending, segments
from chunkloom.plans import build
from chunkloom.session import scratch_path, stored
from chunkloom.sources import readers, writers
from querybook.tables import iso, read


def _entries(spark, folder):
    key = F.col("o_orderkey")
    return read(spark, folder, "orders").select(
        F.when(key % 11 == 0, F.lit(None)).when(key % 11 == 1, "").otherwise(key.cast("string")).alias("id"),
        F.when(key % 3 != 0, F.col("o_orderpriority")).alias("title"),
        F.when(key % 4 != 0, F.date_format("o_orderdate", "yyyyMMdd")).alias("upload_date"),
    )


def listing_clean(spark, folder):
    return metadata.clean_listing(_entries(spark, folder))


def video_count(spark, folder):
    return metadata.count_videos(listing_clean(spark, folder))


def meta_fallback(spark, folder):
    key = F.col("o_orderkey")
    videos = read(spark, folder, "orders").select(
        key.alias("video_id"),
        F.when(key % 3 == 0, "").when(key % 3 == 1, F.col("o_orderpriority")).alias("title"),
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, "2000-01-01").otherwise(iso("o_orderdate")).alias("upload_date"),
    )
    first = read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("video_id"),
        F.col("l_returnflag").alias("title"),
        F.when(F.col("l_orderkey") % 5 < 2, iso("l_shipdate")).alias("upload_date"),
    )
    second = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("video_id"), F.col("c_name").alias("title"), F.lit("2001-05-05").alias("upload_date")
    )
    return metadata.repair(videos, first, second)


def meta_fallback_raw(spark, folder):
    """Sources as they come: compact dates in the first, some broken or missing, ISO dates in the second."""
    key = F.col("o_orderkey")
    videos = read(spark, folder, "orders").select(
        key.alias("video_id"), F.lit("").alias("title"),
        F.when(key % 3 == 0, F.lit(None)).when(key % 3 == 1, "2000-01-01").otherwise(iso("o_orderdate")).alias("upload_date"),
    )
    line = F.col("l_orderkey")
    first = read(spark, folder, "lineitem").select(
        line.alias("video_id"), F.col("l_returnflag").alias("title"),
        F.when(line % 5 == 0, F.lit(None)).when(line % 5 == 1, "not a date").when(line % 5 == 2, "20250231")
        .otherwise(F.date_format("l_shipdate", "yyyyMMdd")).alias("upload_date"),
    )
    second = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("video_id"), F.col("c_name").alias("title"),
        F.when(F.col("c_custkey") % 7 != 0, "2001-05-05").otherwise("soon").alias("upload_date"),
    )
    return metadata.repair(videos, first, second)


def build_rerun(spark, folder):
    """Built from half of the segments, then once more from all, leaving out what is there."""
    path = scratch_path(spark, "chunks")
    half = F.pmod(F.xxhash64("video_id"), F.lit(2)) == 0
    writers.write_chunks(_built(spark, folder, half).chunks, path)
    done = stored(readers.read_chunks(spark, path).select("video_id").distinct(), "done")
    writers.write_chunks(_built(spark, folder, done=done).chunks, path, keep=True)
    chunks = readers.read_chunks(spark, path)
    return chunks.withColumn("elements", F.size("embedding").cast("bigint")).drop("embedding")


def segment_join(spark, folder):
    docs = read(spark, folder, "documents").select(F.col("doc_id").alias("video_id"), "source", "n_chars")
    videos = read(spark, folder, "labels").select(F.col("doc_id").alias("video_id"), F.col("quality").alias("title"))
    return segments.attach_videos(docs, videos)


def image_join(spark, folder):
    """Every second turn has an image, listed twice."""
    turns = read(spark, folder, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("chunk_id"))
    images = turns.filter("chunk_id % 2 = 0")
    return segments.attach_images(turns, images.unionAll(images), "chunk_images")


def _finished(spark, folder):
    return (
        read(spark, folder, "labels").select(F.col("doc_id").alias("video_id")),
        read(spark, folder, "embeddings").select(F.col("vec_id").alias("video_id")),
    )


def _documents(spark, folder):
    return read(spark, folder, "documents").select(F.col("doc_id").alias("video_id"), "lang")


def unprocessed(spark, folder):
    return pending.unprocessed(_documents(spark, folder), *_finished(spark, folder))


def reusable(spark, folder):
    return pending.reusable(_documents(spark, folder), *_finished(spark, folder))


def _typed_events(spark, folder):
    """Ids and times as text, some of them broken."""
    key = F.col("event_id")
    return segments.type_columns(
        read(spark, folder, "events").select(
            F.col("user_id").alias("video_id"),
            F.when(key % 10 == 1, "x1").when(key % 10 != 2, key.cast("string")).alias("id"),
            F.when(key % 10 == 3, "soon").when(key % 10 == 4, "NaN").otherwise(F.col("value").cast("string")).alias("start"),
            F.when(key % 10 == 5, "1e300").when(key % 10 != 6, F.col("value").cast("string")).alias("end"),
            F.col("event_type").alias("text"),
        )
    )


def typed_accepted(spark, folder):
    return segments.accepted(_typed_events(spark, folder))


def typed_rejected(spark, folder):
    return segments.rejected(_typed_events(spark, folder)).select("video_id", "text", "reject_reason")


def segment_counts(spark, folder):
    return segments.count_segments(read(spark, folder, "conversations").withColumnRenamed("conv_id", "video_id"))


def default_embedding(spark, folder):
    """Size and length of the hashed word vectors, and the places of the words: blank texts have the zero vector.

    Each turn has its role as text, once, twice or thrice, besides a word of its own: the
    element of the role is as many times as large as that of the other word.
    """
    times = F.col("turn").cast("int") % 3
    turns = read(spark, folder, "conversations").withColumn("text", F.when(times != 0, F.concat(F.repeat(F.concat("role", F.lit(" ")), times), F.lit("word"))))
    length = F.aggregate("embedding", F.lit(0.0), lambda a, e: a + e * e)
    filled = F.filter("embedding", lambda e: e > 0)
    return embedding.embed(turns).select(
        "conv_id",
        "turn",
        F.size("embedding").cast("bigint").alias("elements"),
        F.round(length, 6).alias("length"),
        F.array_join(F.transform(F.array_sort(filled), lambda e: F.format_number(e, 4)), " ").alias("filled"),
    )


@F.pandas_udf(ArrayType(DoubleType()))
def _picky(texts: pd.Series) -> pd.Series:
    """A model that fails on a batch with a text whose number of letters is a multiple of seven."""
    for text in texts:
        if len(text) % 7 == 0:
            raise ValueError(f"{len(text)} letters")
    return texts.map(lambda text: [float(len(text)), 1.0])


def model_rejects(spark, folder):
    """What the build makes of documents with such a model: chunks and rejects, each with its reason."""
    docs = read(spark, folder, "documents").withColumn("text", F.trim(F.regexp_replace("text", r"[^\x21-\x7e]+", " ")))
    segments_of = docs.select(
        F.col("doc_id").cast("string").alias("video_id"), F.lit("1").alias("id"), F.lit("0").alias("start"), F.lit("1.5").alias("end"), "text"
    )
    entries = docs.select(F.col("doc_id").cast("string").alias("id"), "lang", F.lit("20250711").alias("upload_date")).withColumnRenamed("lang", "title")
    images = docs.select(F.col("doc_id").cast("string").alias("video_id"), F.lit(1).alias("chunk_id"))
    built = build.build_chunks(entries, segments_of, images, model=_picky)
    kept = built.chunks.select("video_id", F.element_at("embedding", 1).alias("letters"), F.lit(None).cast("string").alias("reject_reason"))
    return kept.unionByName(built.rejects.select("video_id", F.lit(None).cast("double").alias("letters"), "reject_reason"))


def _built(spark, folder, which=None, done=None):
    turn = F.col("turn")
    turns = read(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.when(turn != 6, turn.cast("string")).otherwise("six").alias("id"),
        (turn * F.lit(7.5)).cast("string").alias("start"),
        (turn * F.lit(7.5) + 4.25).cast("string").alias("end"),
        F.when(turn != 4, F.concat(F.lit("　"), F.col("text"))).alias("text"),
    )
    images = read(spark, folder, "conversations").filter("turn % 2 = 0").select(
        F.col("conv_id").cast("string").alias("video_id"), F.col("turn").cast("int").alias("chunk_id")
    )
    turns = turns if which is None else turns.filter(which)
    return build.build_chunks(_entries(spark, folder), turns, images, ["the of", "que la"], done=done)


def chunk_table(spark, folder):
    chunks = _built(spark, folder).chunks
    return chunks.withColumn("elements", F.size("embedding").cast("bigint")).drop("embedding")


def chunk_rejects(spark, folder):
    return _built(spark, folder).rejects


_SQL_ENTRIES = """
  select cast(o_orderkey as varchar) as video_id,
         case when o_orderkey % 3 <> 0 then o_orderpriority else '' end as title,
         case when o_orderkey % 4 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end as upload_date
  from orders where o_orderkey % 11 > 1"""
_SQL_DONE = "(doc_id in (select doc_id from labels) and doc_id in (select vec_id from embeddings))"
_SQL_GOOD = "event_id % 10 not in (1, 2, 3, 4, 5, 6)"
_SQL_KEPT = r"""
  select cast(conv_id as varchar) as video_id, turn, text from conversations
  where turn <> 4 and text <> ''
    and not (contains(lower(text), 'the of') or contains(lower(text), 'que la')
      or contains(lower(regexp_replace(text, '[^\p{L}\p{N}]+', '', 'g')), 'theof')
      or contains(lower(regexp_replace(text, '[^\p{L}\p{N}]+', '', 'g')), 'quela'))"""
_SQL_CHUNKS = f"""
  select k.video_id, e.title, e.upload_date, cast(turn as integer) as chunk_id,
         '00:00:' || lpad(cast(turn * 15 // 2 as varchar), 2, '0') || case when turn % 2 = 1 then '.500000' else '' end as start_time,
         '00:00:' || lpad(cast((turn * 30 + 17) // 4 as varchar), 2, '0') || case when turn % 2 = 1 then '.750000' else '.250000' end as end_time,
         k.text, case when turn % 2 = 0 then 'chunk_images/' || k.video_id || '/' || turn || '.jpg' end as image_path,
         cast(256 as bigint) as elements
  from ({_SQL_KEPT}) k join ({_SQL_ENTRIES}) e on e.video_id = k.video_id where turn <> 6"""

PAIRS = {
    "listing_clean": (listing_clean, _SQL_ENTRIES),
    "video_count": (video_count, f"select count(*) as videos from ({_SQL_ENTRIES})"),
    "meta_fallback": (
        meta_fallback,
        """
  with v as (
    select o_orderkey as id, case o_orderkey % 3 when 0 then '' when 1 then o_orderpriority end as t,
           case o_orderkey % 4 when 0 then null when 1 then '2000-01-01' else strftime(o_orderdate, '%Y-%m-%d') end as d
    from orders),
  a as (
    select l_orderkey as id, strftime(l_shipdate, '%Y-%m-%d') as d, l_returnflag as t from lineitem
    where l_orderkey % 5 < 2
    qualify row_number() over (partition by l_orderkey order by l_shipdate desc, l_returnflag desc) = 1)
  select v.id as video_id,
         case when coalesce(v.t, '') <> '' then v.t
              when v.d is not null and v.d <> '2000-01-01' then ''
              when a.d is not null then a.t else coalesce(c_name, '') end as title,
         case when v.d is not null and v.d <> '2000-01-01' then v.d
              when a.d is not null then a.d when c_custkey is not null then '2001-05-05' else v.d end as upload_date
  from v left join a on a.id = v.id left join customer on c_custkey = v.id""",
    ),
    "meta_fallback_raw": (
        meta_fallback_raw,
        """
  with v as (
    select o_orderkey as id, case o_orderkey % 3 when 0 then null when 1 then '2000-01-01' else strftime(o_orderdate, '%Y-%m-%d') end as d
    from orders),
  a as (
    select l_orderkey as id, strftime(l_shipdate, '%Y-%m-%d') as d, l_returnflag as t from lineitem where l_orderkey % 5 > 2
    qualify row_number() over (partition by l_orderkey order by l_shipdate desc, l_returnflag desc) = 1),
  b as (select c_custkey as id, c_name as t from customer where c_custkey % 7 <> 0)
  select v.id as video_id,
         case when v.d <> '2000-01-01' then '' when a.d is not null then a.t else coalesce(b.t, '') end as title,
         case when v.d <> '2000-01-01' then v.d when a.d is not null then a.d when b.id is not null then '2001-05-05' else v.d end as upload_date
  from v left join a on a.id = v.id left join b on b.id = v.id""",
    ),
    "segment_join": (
        segment_join,
        "select d.doc_id as video_id, source, n_chars, quality as title from documents d join labels l on l.doc_id = d.doc_id",
    ),
    "image_join": (
        image_join,
        """
  select conv_id as video_id, turn as chunk_id,
         case when turn % 2 = 0 then 'chunk_images/' || conv_id || '/' || turn || '.jpg' end as image_path
  from conversations""",
    ),
    "unprocessed": (unprocessed, f"select doc_id as video_id, lang from documents where not {_SQL_DONE}"),
    "reusable": (reusable, f"select doc_id as video_id, lang from documents where {_SQL_DONE}"),
    "typed_accepted": (
        typed_accepted,
        f"""
  select user_id as video_id, event_type as text, cast(event_id as integer) as chunk_id, value as start_s, value as end_s
  from events where {_SQL_GOOD}""",
    ),
    "typed_rejected": (
        typed_rejected,
        f"""
  select user_id as video_id, event_type as text,
         case when event_id % 10 in (1, 2) then 'segment id is not an integer' else 'start or end is not a time' end as reject_reason
  from events where not ({_SQL_GOOD})""",
    ),
    "segment_counts": (segment_counts, "select conv_id as video_id, count(*) as segments from conversations group by conv_id"),
    "default_embedding": (
        default_embedding,
        """
  select conv_id, turn, cast(256 as bigint) as elements, case when turn % 3 <> 0 then 1.0::double else 0.0::double end as length,
         case turn % 3 when 0 then '' when 1 then '0.7071 0.7071' else '0.4472 0.8944' end as filled
  from conversations""",
    ),
    "model_rejects": (
        model_rejects,
        r"""
  with d as (select doc_id, length(trim(regexp_replace(text, '[^\x21-\x7e]+', ' ', 'g'))) as n from documents)
  select cast(doc_id as varchar) as video_id, case when n % 7 <> 0 then cast(n as double) end as letters,
         case when n % 7 = 0 then 'model failed: ValueError: ' || n || ' letters' end as reject_reason
  from d where n > 0""",
    ),
    "build_rerun": (build_rerun, _SQL_CHUNKS),
    "chunk_table": (chunk_table, _SQL_CHUNKS),
    "chunk_rejects": (
        chunk_rejects,
        f"""
  select video_id, 'six' as id, '45.0' as start, '49.25' as end, text, 'segment id is not an integer' as reject_reason
  from ({_SQL_KEPT}) where turn = 6 and video_id in (select video_id from ({_SQL_ENTRIES}))""",
    ),
}
