"""Sinks and scans: whole tables are written to the shared scratch folder and read back."""

from pyspark.sql import functions as F

from chunkloom.session import scratch_path
from chunkloom.plans import export, listings
from chunkloom.sources import database, readers, writers
from chunkloom.streaming import ingest
from querybook.tables import read


def _turns(spark, folder):
    return read(spark, folder, "conversations").select(
        F.lpad(F.col("conv_id").cast("string"), 6, "0").alias("video_id"), "turn", "text"
    )


def parquet_relocation(spark, folder):
    """Written twice: the second copy replaces the first and adds nothing."""
    path = scratch_path(spark, "relocated")
    source = read(spark, folder, "events").select("event_id", "user_id", "value", "props")
    writers.relocate(source, path)
    writers.relocate(source, path)
    return readers.load_any(spark, f" '{path}' ")


def chunk_rewrite(spark, folder):
    path = scratch_path(spark, "chunks")
    vectors = read(spark, folder, "embeddings").select(
        F.col("label").cast("string").alias("video_id"), F.col("vec_id").cast("string").alias("chunk_id"), "embedding",
        *[F.lit(None).cast("string").alias(name) for name in ("title", "upload_date", "start_time", "end_time", "text", "image_path")],
    )
    writers.write_chunks(vectors, path)
    back = readers.read_chunks(spark, path)
    return back.select("video_id", "chunk_id", "title", F.posexplode("embedding").alias("pos", "value"))


def json_lines_scan(spark, folder):
    path = scratch_path(spark, "lines")
    _turns(spark, folder).write.json(path)
    return readers.load_any(spark, f"{path}/*.json")


def _dealt(records, size):
    """Records in groups of about so many, for one file each: neither many small files nor files that grow with the table."""
    groups = max(1, -(-records.count() // size))
    return records.groupBy(F.pmod(F.monotonically_increasing_id(), F.lit(groups)))


def _write_arrays(records, path, size):
    """One JSON array per file, of about `size` records each."""
    value = F.to_json(F.collect_list(F.struct("video_id", "turn", "text"))).alias("value")
    # One record per file is one array per file.
    _dealt(records, size).agg(value).select("value").write.option("maxRecordsPerFile", 1).text(path)


def _mixed_files(spark, folder, arrays_larger):
    """Even conversations as one JSON array per file, odd ones as lines; one kind in larger files."""
    path = scratch_path(spark, "mixed")
    turns = _turns(spark, folder)
    parity = F.substring("video_id", -1, 1).cast("int") % 2
    _write_arrays(turns.filter(parity == 0), f"{path}/arrays", 5000 if arrays_larger else 500)
    lines = turns.filter(parity == 1)
    lines = lines.repartition(12) if arrays_larger else lines
    lines.write.option("maxRecordsPerFile", 500 if arrays_larger else 5000).json(f"{path}/lines")
    return f"{path}/*/part*"


def json_array_scan(spark, folder):
    path = scratch_path(spark, "arrays")
    _write_arrays(_turns(spark, folder), path, 5000)
    return readers.read_json(spark, f"{path}/part*")


def json_mixed_scan(spark, folder):
    """Twice: with the files of arrays the larger ones, and the smaller ones."""
    first, second = (readers.read_json(spark, _mixed_files(spark, folder, larger)) for larger in (True, False))
    return first.withColumn("larger", F.lit("arrays")).unionByName(second.withColumn("larger", F.lit("lines")))


def csv_scan(spark, folder):
    """Texts with line breaks and quotes, types inferred; vectors come back as text."""
    path = scratch_path(spark, "csv")
    turns = read(spark, folder, "conversations").withColumn("text", F.concat(F.lit('"quoted", '), F.col("text")))
    turns.write.option("header", True).option("escape", '"').csv(path)
    back = readers.load_any(spark, f"{path}/*.csv")
    return back.withColumns({"conv_id": F.col("conv_id").cast("bigint"), "turn": F.col("turn").cast("bigint")})


def segment_store(spark, folder):
    """One bucket per video; the second write adds the videos the first one lacks."""
    path = scratch_path(spark, "segments")
    turns = _turns(spark, folder).select(
        "video_id", F.col("turn").alias("id"), (F.col("turn") * 2.5).alias("start"), (F.col("turn") * 2.5 + 1).alias("end"), "text"
    )
    first = F.col("video_id") < "000050"
    writers.write_segments(turns.filter(first), path)
    writers.write_segments(turns.filter(~first), path)
    return readers.read_segments(spark, path)


def _rerun(spark, folder, buckets, later=None):
    path = scratch_path(spark, "summaries")
    videos = _turns(spark, folder).select(F.when(F.col("video_id") != "000007", F.col("video_id")).otherwise("").alias("video_id")).distinct()
    summary = videos.withColumn("summary_text", F.concat(F.lit("first "), "video_id")).withColumn("video_url", F.col("video_id"))
    writers.write_summaries(summary, path, buckets)
    again = summary.filter("video_id like '%3'").withColumn("summary_text", F.concat(F.lit("second "), "video_id"))
    writers.write_summaries(again, path, later or buckets)
    return readers.read_summaries(spark, path)


def summary_rerun(spark, folder):
    return _rerun(spark, folder, None)


def summary_rerun_buckets(spark, folder):
    return _rerun(spark, folder, 8)


def summary_rerun_other_buckets(spark, folder):
    """A rerun that asks for another number of buckets; an empty id stays empty."""
    return _rerun(spark, folder, 8, 16)


def summary_lookup_pruned(spark, folder):
    """A summary from the stored table, whose other buckets are not opened, and an id that it lacks."""
    path = scratch_path(spark, "summaries")
    part = read(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("video_id"),
        F.col("p_name").alias("summary_text"),
        F.concat(F.lit("https://youtu.be/"), F.col("p_partkey").cast("string")).alias("video_url"),
    )
    writers.write_summaries(part, path)
    found = [listings.summary_of(readers.read_summaries_of(spark, path, key), key) for key in ("70", "-1")]
    return found[0].unionByName(found[1])


def segment_ingest(spark, folder):
    """Segments that arrive in three parts, with a run after each and one when nothing is new."""
    arrived, path, checkpoint = (scratch_path(spark, name) for name in ("arrived", "segments", "checkpoint"))
    own = F.col("turn").cast("string")
    turns = read(spark, folder, "conversations").select(
        F.lpad(F.col("conv_id").cast("string"), 6, "0").alias("video_id"), own.alias("id"), own.alias("start"), own.alias("end"), "text"
    )
    for part in (0, 1, 2, None):
        if part is not None:
            new = turns.filter(F.pmod(F.xxhash64("video_id", "id"), F.lit(3)) == part).coalesce(2)
            new.write.mode("append").json(arrived)
        ingest.catch_up(readers.stream_segments(spark, arrived), path, checkpoint)
    return spark.read.parquet(path)


def listing_scan(spark, folder):
    """Listings of about five thousand entries per file, some with keys that are not read."""
    path = scratch_path(spark, "listings")
    key = F.col("o_orderkey")
    entry = F.struct(key.cast("string").alias("id"), F.col("o_orderpriority").alias("title"),
                     F.date_format("o_orderdate", "yyyyMMdd").alias("upload_date"), key.alias("views"))
    listing = F.to_json(F.struct(F.collect_list(entry).alias("entries"))).alias("value")
    files = _dealt(read(spark, folder, "orders"), 5000).agg(listing)
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_listing(spark, path)


def export_copy(spark, folder):
    """The export job without a database, run twice."""
    source, target = scratch_path(spark, "chunks"), scratch_path(spark, "copy")
    writers.write_chunks(_vector_rows(spark, folder), source)
    for _ in range(2):
        export.export_chunks(spark, source, target)
    return database.to_relational(readers.read_chunks(spark, target))


def _vector_rows(spark, folder):
    return read(spark, folder, "embeddings").select(
        F.col("label").cast("string").alias("video_id"),
        F.lit("t").alias("title"),
        F.lit("2025-07-11").alias("upload_date"),
        F.col("vec_id").cast("int").alias("chunk_id"),
        F.lit("00:00:00").alias("start_time"),
        F.lit("00:00:01").alias("end_time"),
        F.lit("x").alias("text"),
        F.transform("embedding", lambda e: F.round(e.cast("double") * 100).cast("int") / 4).alias("embedding"),
        F.lit(None).cast("string").alias("image_path"),
    )


def relational_rows(spark, folder):
    return database.to_relational(_vector_rows(spark, folder))


def relational_rows_new(spark, folder):
    """Only chunks the stored table lacks."""
    rows = relational_rows(spark, folder)
    return database.without_existing(rows, rows.filter("chunk_id % 3 = 0")).select("video_id", "chunk_id")


_SQL_VIDEOS = "select distinct case when conv_id <> 7 then lpad(cast(conv_id as varchar), 6, '0') else '' end as video_id from conversations"
_SQL_RERUN = f"""
  select video_id, case when video_id like '%3' then 'second ' else 'first ' end || video_id as summary_text,
         video_id as video_url from ({_SQL_VIDEOS})"""
_SQL_QUARTERS = "list_transform(embedding, lambda e: cast(round(cast(e as double) * 100) as integer) / cast(4 as double))"

_SQL_TURNS = "select lpad(cast(conv_id as varchar), 6, '0') as video_id, turn, text from conversations"
_SQL_RELATIONAL = f"""
  select cast(label as varchar) as video_id, 't' as title, '2025-07-11' as upload_date, cast(vec_id as integer) as chunk_id,
         '00:00:00' as start_time, '00:00:01' as end_time, 'x' as text,
         '[' || array_to_string(list_transform({_SQL_QUARTERS}, lambda e: cast(e as varchar)), ',') || ']' as embedding,
         cast(null as varchar) as image_path
  from embeddings"""

PAIRS = {
    "parquet_relocation": (parquet_relocation, "select event_id, user_id, value, props from events"),
    "chunk_rewrite": (
        chunk_rewrite,
        """
  select cast(label as varchar) as video_id, cast(vec_id as integer) as chunk_id, cast(null as varchar) as title,
         cast(generate_subscripts(embedding, 1) - 1 as integer) as pos, unnest(cast(embedding as double[])) as value
  from embeddings""",
    ),
    "json_lines_scan": (
        json_lines_scan,
        _SQL_TURNS,
    ),
    "json_array_scan": (json_array_scan, _SQL_TURNS),
    "json_mixed_scan": (json_mixed_scan, f"select *, unnest(['arrays', 'lines']) as larger from ({_SQL_TURNS})"),
    "csv_scan": (csv_scan, "select conv_id, turn, role, '\"quoted\", ' || text as text from conversations"),
    "segment_store": (
        segment_store,
        """
  select lpad(cast(conv_id as varchar), 6, '0') as video_id, cast(turn as varchar) as id,
         cast(turn * cast(2.5 as double) as varchar) as start, cast(turn * cast(2.5 as double) + 1 as varchar) as end, text
  from conversations""",
    ),
    "summary_rerun": (summary_rerun, _SQL_RERUN),
    "summary_rerun_buckets": (summary_rerun_buckets, _SQL_RERUN),
    "summary_rerun_other_buckets": (summary_rerun_other_buckets, _SQL_RERUN),
    "summary_lookup_pruned": (
        summary_lookup_pruned,
        """
  select p_name as summary_text, 'https://youtu.be/' || p_partkey as video_url, 'https://www.youtube.com/embed/' || p_partkey as embed_url
  from part where p_partkey = 70""",
    ),
    "segment_ingest": (
        segment_ingest,
        """
  select lpad(cast(conv_id as varchar), 6, '0') as video_id, cast(turn as varchar) as id, cast(turn as varchar) as start,
         cast(turn as varchar) as end, text
  from conversations""",
    ),
    "listing_scan": (
        listing_scan,
        "select cast(o_orderkey as varchar) as id, o_orderpriority as title, strftime(o_orderdate, '%Y%m%d') as upload_date from orders",
    ),
    "export_copy": (export_copy, _SQL_RELATIONAL),
    "relational_rows": (relational_rows, _SQL_RELATIONAL),
    "relational_rows_new": (
        relational_rows_new,
        "select cast(label as varchar) as video_id, cast(vec_id as integer) as chunk_id from embeddings where vec_id % 3 <> 0",
    ),
}
