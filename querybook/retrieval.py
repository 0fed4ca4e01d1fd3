"""Centroids, top chunks, contexts and summaries.

embeddings rows are chunks (vec_id) of the video label; conversations rows are
chunks (turn) of the video conv_id.
"""

import re

from pyspark.sql import functions as F

from chunkloom import fixed_values as fv
from chunkloom.functions import batches
from chunkloom.operators import kept_sums, retrieval, summaries
from chunkloom.plans import summarise
from chunkloom.session import scratch_path
from querybook.tables import read


def _vectors(spark, folder):
    return read(spark, folder, "embeddings").select(
        F.col("label").alias("video_id"),
        F.col("vec_id").alias("chunk_id"),
        F.col("vec_id").cast("string").alias("text"),
        "embedding",
    )


def _picked(chunks, **options):
    return retrieval.top_chunks(chunks, embedding="embedding", **options).select("video_id", "chunk_id")


def centroid_topk(spark, folder):
    return _picked(_vectors(spark, folder))


def _odd_labels_nulled(spark, folder):
    return _vectors(spark, folder).withColumn(
        "embedding", F.when(F.col("video_id") % 2 == 0, F.col("embedding"))
    )


def head_k_fallback(spark, folder):
    return _picked(_odd_labels_nulled(spark, folder))


def partly_valid_topk(spark, folder):
    """Null, NaN and empty vectors among valid ones; two labels become the null video id."""
    vector = (
        F.when(F.col("chunk_id") % 7 == 0, F.lit(None))
        .when(F.col("chunk_id") % 7 == 1, F.transform("embedding", lambda e: F.lit(float("nan")).cast("float")))
        .when(F.col("chunk_id") % 7 == 2, F.array().cast("array<float>"))
        .otherwise(F.col("embedding"))
    )
    chunks = _vectors(spark, folder).withColumn("embedding", vector)
    return _picked(chunks.withColumn("video_id", F.when(F.col("video_id") % 5 != 0, F.col("video_id"))), k=9)


def hot_video_topk(spark, folder):
    """Half of all vectors belong to one video; the limit is set so that its join is split."""
    chunks = _vectors(spark, folder).withColumn("video_id", F.when(F.col("video_id") < 5, -1).otherwise(F.col("video_id")))
    return _picked(chunks, hot_rows=60)


def mixed_size_rejects(spark, folder):
    """Every third label has vectors of two sizes."""
    cut = F.when((F.col("video_id") % 3 == 0) & (F.col("chunk_id") % 2 == 0), F.slice("embedding", 1, 8))
    chunks = _vectors(spark, folder).withColumn("embedding", F.coalesce(cut, F.col("embedding")))
    return retrieval.vector_rejects(retrieval.centroids(chunks, "embedding"))


def centroid_values(spark, folder):
    table = retrieval.centroids(_vectors(spark, folder), "embedding")
    return table.select("video_id", "n_rows", F.posexplode("centroid").alias("pos", "value")).withColumn(
        "value", F.round("value", 6) + 0.0
    )


def centroid_incremental(spark, folder):
    """The means from sums that two builds have kept, each of which has chunks of every video; the second ran twice."""
    path = scratch_path(spark, "sums")
    chunks = _vectors(spark, folder)
    for build, part in (("one", 0), ("two", 1), ("two", 1)):
        kept_sums.append(chunks.filter(F.pmod(F.xxhash64("chunk_id"), F.lit(2)) == part), path, build)
    table = kept_sums.centroids(spark, path)
    return table.select("video_id", "n_rows", F.posexplode("centroid").alias("pos", "value")).withColumn(
        "value", F.round("value", 6) + 0.0
    )


def chunk_similarity(spark, folder):
    chunks = _vectors(spark, folder)
    scored = retrieval.similarities(chunks, retrieval.stored_centroids(chunks, "embedding"), "embedding")
    return scored.select("video_id", "chunk_id", (F.round("sim", 6) + 0.0).alias("sim"))


def summary_rejects(spark, folder):
    """Videos in are summaries and rejects: every third label has vectors of two sizes."""
    cut = F.when((F.col("video_id") % 3 == 0) & (F.col("chunk_id") % 2 == 0), F.slice("embedding", 1, 8))
    chunks = _vectors(spark, folder).withColumn("embedding", F.coalesce(cut, F.col("embedding")))
    made = summarise.summarise_videos(chunks)
    kept = made.summaries.select("video_id", F.lit("summary").alias("result"))
    return kept.unionByName(made.rejects.select("video_id", F.col("reject_reason").alias("result")))


def large_k_topk(spark, folder):
    """All lines are one video but for every tenth order; k is beyond what Spark prunes by itself."""
    key = F.col("l_orderkey")
    lines = read(spark, folder, "lineitem").select(
        F.when(key % 10 == 0, key % 7).otherwise(-1).alias("video_id"),
        (key * 10 + F.col("l_linenumber")).alias("chunk_id"),
        F.col("l_returnflag").alias("text"),
    )
    return retrieval.top_chunks(lines, k=1500)


def unit_vectors(spark, folder):
    chunks = _vectors(spark, folder)
    scaled = batches.unit(F.transform("embedding", lambda e: e.cast("double") * 3))
    return chunks.select("chunk_id", F.posexplode(scaled).alias("pos", "value")).withColumn(
        "value", F.round("value", 6) + 0.0
    )


def _turns(spark, folder):
    return read(spark, folder, "conversations").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("chunk_id"), "role", "text"
    )


def context_concat(spark, folder):
    chunks = _turns(spark, folder).withColumn("text", F.when(F.col("chunk_id") % 3 != 0, F.col("text")))
    return retrieval.contexts(retrieval.top_chunks(chunks, k=5))


def chunk_order(spark, folder):
    return retrieval.in_chunk_order(_turns(spark, folder)).select("video_id", "chunk_id", "role")


def extractive_summary(spark, folder):
    """Every seventh conversation has blank texts only."""
    text = F.when(F.col("video_id") % 7 == 0, F.lit(" \t")).otherwise(F.col("text"))
    return summarise.summarise_videos(_turns(spark, folder).withColumn("text", text)).summaries


def centroid_summary(spark, folder):
    """The whole job on vectors: documents are the texts of the embeddings of the same number."""
    docs = read(spark, folder, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    chunks = _vectors(spark, folder).drop("text").join(docs, "chunk_id")
    return summarise.summarise_videos(chunks, top_k=3).summaries


def default_draft(spark, folder):
    contexts = read(spark, folder, "documents").select(
        F.col("doc_id").alias("video_id"), F.col("text").alias("context")
    )
    return summaries.summarise(contexts).select("video_id", "summary_text")


def _sql_topk(chunks, k=12):
    """Brute force: every unit vector against every mean, ranks by similarity."""
    return f"""
  with chunks as ({chunks}),
  valid as (
    select video_id, chunk_id, list_transform(embedding, lambda e:
             e / greatest(sqrt(list_inner_product(embedding, embedding)), 1e-6)) as u
    from chunks where embedding is not null and len(embedding) > 0 and not isnan(embedding[1])
  ),
  elements as (select video_id, unnest(u) as e, generate_subscripts(u, 1) as pos from valid),
  means as (select video_id, pos, avg(e) as m from elements group by all),
  centroids as (select video_id, list(m order by pos) as q from means group by video_id),
  scored as (
    select v.video_id, v.chunk_id, list_inner_product(u, q) as sim
    from valid v join centroids c on v.video_id is not distinct from c.video_id
    union all
    select video_id, chunk_id, 0 from chunks a
    where not exists (select 1 from centroids c where c.video_id is not distinct from a.video_id)
  )
  select video_id, chunk_id from scored
  qualify row_number() over (partition by video_id order by sim desc, chunk_id) <= {k}"""


_SQL_VECTORS = "select label as video_id, vec_id as chunk_id, cast(embedding as double[]) as embedding from embeddings"
_SQL_UNITS = """
  units as (
    select label as video_id, vec_id as chunk_id,
           list_transform(cast(embedding as double[]), lambda e:
             e / greatest(sqrt(list_inner_product(cast(embedding as double[]), cast(embedding as double[]))), 1e-6)) as u
    from embeddings
  ),
  elements as (select video_id, chunk_id, unnest(u) as e, generate_subscripts(u, 1) - 1 as pos from units),
  means as (select video_id, pos, avg(e) as m, count(*) as n from elements group by all)"""

# No look-behind here: sentence ends get a mark first, and the text is split at the marks.
_HEADING = rf"###\s*(?:{'|'.join(fv.HEADING_WORDS)})\s*:?.*?$"
_CHAT = f"{re.escape(fv.CHAT_OPEN)}.*?{re.escape(fv.CHAT_CLOSE)}"
_ROLE = rf"^\s*(?:{'|'.join(fv.ROLE_WORDS)})\b.*$"
SQL_STRIP_ECHO = rf"""
  array_to_string(list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace(
    case when instr({{text}}, '{fv.SUMMARY_MARKER}') > 0
      then substr({{text}}, instr({{text}}, '{fv.SUMMARY_MARKER}') + {len(fv.SUMMARY_MARKER)}) else {{text}} end,
    '(?ims)(?:{_HEADING})|(?:{_CHAT})|(?:{_ROLE})',
    '', 'g'), chr(9) || chr(10) || chr(13) || ' ' || chr(12288)), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
    lambda s: trim(s, chr(9) || chr(10) || chr(13) || ' ' || chr(12288))), lambda s: s <> '')[1:7], ' ')"""


def _sql_clean_twice(source, text):
    once = SQL_STRIP_ECHO.format(text=text)
    twice = SQL_STRIP_ECHO.format(text="once")
    return f"select * exclude (once), {twice} as twice from (select *, {once} as once from ({source}))"


def _sql_summaries(contexts):
    return f"""
  select video_id,
         case when regexp_full_match(context, '\\s*') then '(내용 없음)' else twice end as summary_text,
         'https://youtu.be/' || video_id as video_url
  from ({_sql_clean_twice(contexts, "context")})"""


_SQL_CONTEXTS = """
  select conv_id as video_id, string_agg({text}, chr(10) order by turn) as context
  from conversations where {where} group by conv_id"""

PAIRS = {
    "centroid_topk": (centroid_topk, _sql_topk(_SQL_VECTORS)),
    "head_k_fallback": (
        head_k_fallback,
        _sql_topk(f"select * replace (case when video_id % 2 = 0 then embedding end as embedding) from ({_SQL_VECTORS})"),
    ),
    "partly_valid_topk": (
        partly_valid_topk,
        _sql_topk(
            f"""select case when video_id % 5 <> 0 then video_id end as video_id, chunk_id,
                       case when chunk_id % 7 > 2 then embedding end as embedding from ({_SQL_VECTORS})""",
            9,
        ),
    ),
    "hot_video_topk": (
        hot_video_topk,
        _sql_topk(f"select * replace (case when video_id < 5 then -1 else video_id end as video_id) from ({_SQL_VECTORS})"),
    ),
    "mixed_size_rejects": (
        mixed_size_rejects,
        """
  select label as video_id, count(*) as n_rows, count(*) as n_vectors, cast(2 as bigint) as n_sizes
  from embeddings where label % 3 = 0
  group by label having count(distinct vec_id % 2) = 2""",
    ),
    "centroid_values": (
        centroid_values,
        f"""
  with {_SQL_UNITS}
  select video_id, n as n_rows, cast(pos as integer) as pos, round(m, 6) + 0.0 as value from means""",
    ),
    "centroid_incremental": (
        centroid_incremental,
        f"""
  with {_SQL_UNITS}
  select cast(video_id as varchar) as video_id, n as n_rows, cast(pos as integer) as pos, round(m, 6) + 0.0 as value from means""",
    ),
    "chunk_similarity": (
        chunk_similarity,
        f"""
  with {_SQL_UNITS}
  select video_id, chunk_id, round(sum(e * m), 6) + 0.0 as sim
  from elements join means using (video_id, pos) group by video_id, chunk_id""",
    ),
    "summary_rejects": (
        summary_rejects,
        """
  select label as video_id, case when label % 3 = 0 and count(distinct vec_id % 2) = 2
         then 'vectors differ in size' else 'summary' end as result
  from embeddings group by label""",
    ),
    "large_k_topk": (
        large_k_topk,
        """
  select case when l_orderkey % 10 = 0 then l_orderkey % 7 else -1 end as video_id,
         l_orderkey * 10 + l_linenumber as chunk_id, l_returnflag as text
  from lineitem qualify row_number() over (partition by 1, case when l_orderkey % 10 = 0 then l_orderkey % 7 else -1 end
    order by l_orderkey * 10 + l_linenumber, l_returnflag) <= 1500""",
    ),
    "unit_vectors": (
        unit_vectors,
        f"with {_SQL_UNITS} select chunk_id, cast(pos as integer) as pos, round(e, 6) + 0.0 as value from elements",
    ),
    "context_concat": (
        context_concat,
        _SQL_CONTEXTS.format(text="case when turn % 3 <> 0 then text else '' end", where="turn < 5"),
    ),
    "chunk_order": (chunk_order, "select conv_id as video_id, turn as chunk_id, role from conversations"),
    "extractive_summary": (
        extractive_summary,
        _sql_summaries(
            _SQL_CONTEXTS.format(text="case when conv_id % 7 = 0 then ' ' || chr(9) else text end", where="turn < 12")
        ),
    ),
    "centroid_summary": (
        centroid_summary,
        _sql_summaries(
            f"""
  select p.video_id, string_agg(d.text, chr(10) order by p.chunk_id) as context
  from ({_sql_topk(_SQL_VECTORS + " where vec_id in (select doc_id from documents)", 3)}) p
  join documents d on d.doc_id = p.chunk_id group by p.video_id"""
        ),
    ),
    "default_draft": (
        default_draft,
        f"select video_id, summary_text from ({_sql_summaries('select doc_id as video_id, text as context from documents')})",
    ),
}
