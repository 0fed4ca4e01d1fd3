"""Column functions over whole tables."""

from pyspark.sql import functions as F

from chunkloom.functions import batches, dates, prompts, text, urls, vectors
from chunkloom.operators import segments, summaries
from querybook.retrieval import _sql_clean_twice
from querybook.tables import read

STOP_PHRASES = ["The Of", "de-la", "nicht und", "***", "que el", "?!?"]


def text_normalised(spark, folder):
    return read(spark, folder, "documents").select("doc_id", text.normalise(F.col("text")).alias("bare"))


def strip_blank(spark, folder):
    padded = F.concat(F.lit("　 \t\x1f"), F.col("text"), F.lit("\xa0\n "))
    turns = read(spark, folder, "conversations").withColumn(
        "text",
        F.when(F.col("turn") % 4 == 3, F.lit("　 \n")).when(F.col("turn") % 4 == 2, F.lit(None)).otherwise(padded),
    )
    return segments.strip_and_drop_blank(turns).select("conv_id", "turn", "text")


def stop_phrase_filter(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return segments.drop_stop_phrases(docs, STOP_PHRASES).select("doc_id")


def _phrase_table(spark, folder):
    """Fifty pieces of each document, of nine letters and digits at least; those of every other place read backwards."""
    docs = read(spark, folder, "documents").select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.lit(49))).alias("k"))
    piece = F.substr("text", F.col("k") * 41 + 1, F.col("k") % 8 + 11)
    long_enough = docs.withColumn("piece", piece).filter(F.length(text.normalise(F.col("piece"))) >= 9)
    return long_enough.select(F.when(F.col("k") % 2 == 0, F.col("piece")).otherwise(F.reverse("piece")).alias("phrase"))


def stop_phrase_many(spark, folder):
    """Turns without any of the pieces of the documents: 50,000 phrases on a thousand documents."""
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "text")
    return segments.drop_stop_phrases(turns, _phrase_table(spark, folder)).select("conv_id", "turn")


def stop_phrase_joined(spark, folder):
    """The same by joins, as for phrases that are too many for each task to hold."""
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "text")
    return segments.drop_stop_phrases(turns, _phrase_table(spark, folder), phrase_bytes=0).select("conv_id", "turn")


def _echoed(spark, folder):
    """Conversation texts with prompt remains, of another kind for each turn."""
    own = F.col("text")
    return read(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("turn") % 6 == 0, F.concat(F.lit("Intro. "), own, F.lit("\n### 요약: "), own))
        .when(F.col("turn") % 6 == 1, F.concat(own, F.lit("\n  Assistant: more. And more."), own))
        .when(F.col("turn") % 6 == 2, F.concat(F.lit("<|im_start|>system\nx\n<|im_end|>user said. "), own))
        .when(F.col("turn") % 6 == 3, F.concat(F.lit("### 답변\nlost line\n"), own, F.lit("\n### 입력: gone\nEnd.")))
        .when(F.col("turn") % 6 == 4, F.concat(own, F.lit("\nusers stay! systematic too?　Yes.")))
        .otherwise(own)
        .alias("raw"),
    )


def echo_strip(spark, folder):
    once = text.strip_echo(F.col("raw"))
    return _echoed(spark, folder).select("conv_id", "turn", once.alias("once"), text.strip_echo(once).alias("twice"))


def sentence_cap(spark, folder):
    docs = read(spark, folder, "documents")
    parts = text.sentences(F.col("text"))
    return docs.select(
        "doc_id", F.size(parts).cast("bigint").alias("sentences"), F.array_join(F.slice(parts, 1, 3), " ").alias("start")
    )


def _raw_dates(spark, folder):
    day = F.col("o_orderdate")
    compact = F.date_format(day, "yyyyMMdd")
    short = F.concat(F.year(day).cast("string"), F.month(day).cast("string"), F.day(day).cast("string"))
    return read(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 6 == 0, compact)
        .when(F.col("o_orderkey") % 6 == 1, short)
        .when(F.col("o_orderkey") % 6 == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 6 == 3, F.concat(F.year(day).cast("string"), F.lit("0231")))
        .when(F.col("o_orderkey") % 6 == 4, F.concat(compact, F.lit("0")))
        .alias("raw"),
    )


def parse_date(spark, folder):
    return _raw_dates(spark, folder).withColumn("parsed", dates.parse_compact_date(F.col("raw")))


def _spans(spark, folder):
    start = F.col("value") * F.lit(977.0)
    return read(spark, folder, "events").select(
        "event_id", start.alias("start"), (start + (F.col("event_id") % 7 - 1) * F.lit(0.3)).alias("end")
    )


def midpoint(spark, folder):
    return _spans(spark, folder).select("event_id", dates.midpoint(F.col("start"), F.col("end")).alias("mid"))


def time_of_day(spark, folder):
    """Fractions of a second, whole seconds and times beyond a day."""
    at = F.when(F.col("event_id") % 3 == 0, F.floor("start").cast("double")).otherwise(F.col("start"))
    return _spans(spark, folder).select("event_id", dates.time_of_day(at).alias("at"))


def image_path(spark, folder):
    path = urls.image_path("chunk_images", F.col("conv_id").cast("string"), F.col("turn"))
    return read(spark, folder, "conversations").select("conv_id", "turn", path.alias("image_path"))


def video_url(spark, folder):
    return read(spark, folder, "pages").select("page_id", urls.video_url(F.col("page_id").cast("string")).alias("url"))


def embed_url(spark, folder):
    page = F.col("page_id").cast("string")
    url = (
        F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("https://youtu.be/"), page, F.lit("?t=3")))
        .when(F.col("page_id") % 6 == 1, F.concat(F.lit("https://WWW.Example.com/watch?list=a&v=x%2By"), page, F.lit("&v=2#v=3")))
        .when(F.col("page_id") % 6 == 2, F.concat(F.lit("watch "), page))
        .when(F.col("page_id") % 6 == 3, F.lit(None))
        .when(F.col("page_id") % 6 == 4, F.concat(F.lit("http://M.YOUTU.BE:80/"), page))
        .otherwise(F.col("url"))
    )
    return read(spark, folder, "pages").select("page_id", urls.embed_url(url).alias("embed_url"))


def url_query_value(spark, folder):
    return read(spark, folder, "pages").select("page_id", urls.query_value(F.col("url"), "page").alias("page"))


def prompt_text(spark, folder):
    return read(spark, folder, "documents").select("doc_id", prompts.render(F.col("text"), "Be brief.", "Sum up:\n").alias("prompt"))


def prompt_chat(spark, folder):
    template = prompts.ChatTemplate("<{role}>{content}</>\n", "<assistant>")
    prompt = prompts.render(F.col("text"), "Be brief.", "Sum up:\n", template)
    return read(spark, folder, "conversations").select("conv_id", "turn", prompt.alias("prompt"))


def blank_placeholder(spark, folder):
    context = F.when(F.col("turn") % 2 == 0, F.lit(" 　\n")).when(F.col("turn") % 5 == 0, F.lit(None))
    contexts = read(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("video_id"), context.alias("context")
    )
    return summaries.summarise(contexts)


def vector_json_roundtrip(spark, folder):
    stored = read(spark, folder, "embeddings").select(
        "vec_id", vectors.to_json_text(F.col("embedding").cast("array<double>")).alias("embedding")
    )
    parsed = stored.withColumn("v", batches.usable(vectors.as_array(stored, "embedding")))
    return parsed.select("vec_id", F.posexplode("v").alias("pos", "value"))


def vector_text_parse(spark, folder):
    rows = read(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 8 == 0, F.concat(F.lit("["), F.col("value").cast("string"), F.lit(", 1, 2]")))
        .when(F.col("event_id") % 8 == 1, "(1, 2)")
        .when(F.col("event_id") % 8 == 2, "7")
        .when(F.col("event_id") % 8 == 3, "[]")
        .when(F.col("event_id") % 8 == 4, "[1, null]")
        .when(F.col("event_id") % 8 == 5, "[1, NaN]")
        .when(F.col("event_id") % 8 == 6, "[0]")
        .alias("embedding"),
    )
    parsed = rows.withColumn("v", batches.usable(vectors.as_array(rows, "embedding")))
    return parsed.select("event_id", F.array_size("v").cast("bigint").alias("elements"), F.get("v", F.lit(0)).alias("first"))


_BARE = r"lower(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', '', 'g'))"
_SQL_WORDS = " or ".join(f"contains(lower(text), lower('{p}'))" for p in STOP_PHRASES)
_SQL_BARE = " or ".join(
    f"({_BARE.format(repr(p))} <> '' and contains({_BARE.format('text')}, {_BARE.format(repr(p))}))" for p in STOP_PHRASES
)
_SQL_START = "(value * cast(977 as double))"
_SQL_END = f"({_SQL_START} + (event_id % 7 - 1) * cast(0.3 as double))"
_SQL_ECHOED = """
  select conv_id, turn, case turn % 6
    when 0 then 'Intro. ' || text || chr(10) || '### 요약: ' || text
    when 1 then text || chr(10) || '  Assistant: more. And more.' || text
    when 2 then '<|im_start|>system' || chr(10) || 'x' || chr(10) || '<|im_end|>user said. ' || text
    when 3 then '### 답변' || chr(10) || 'lost line' || chr(10) || text || chr(10) || '### 입력: gone' || chr(10) || 'End.'
    -- the ideographic space is written as a plain one, which the pattern below knows
    when 4 then text || chr(10) || 'users stay! systematic too? Yes.'
    else text end as raw
  from conversations"""

_SQL_MANY = r"""
  with k as (select text, unnest(range(50)) as k from documents),
  pieces as (select k, substr(text, k * 41 + 1, k % 8 + 11) as piece from k),
  p as (select case when k % 2 = 0 then piece else reverse(piece) end as p from pieces
    where length(regexp_replace(piece, '[^\p{L}\p{N}]+', '', 'g')) >= 9),
  raw as (select distinct lower(p) as p from p where p <> ''),
  bare as (select distinct lower(regexp_replace(p, '[^\p{L}\p{N}]+', '', 'g')) as p from p where regexp_replace(p, '[^\p{L}\p{N}]+', '', 'g') <> ''),
  t as (select conv_id, turn, lower(text) as r, lower(regexp_replace(text, '[^\p{L}\p{N}]+', '', 'g')) as b from conversations),
  hit as (select conv_id, turn from t join raw on contains(r, p) union select conv_id, turn from t join bare on contains(b, p))
  select conv_id, turn from conversations anti join hit using (conv_id, turn)"""

PAIRS = {
    "text_normalised": (text_normalised, f"select doc_id, {_BARE.format('text')} as bare from documents"),
    "strip_blank": (
        strip_blank,
        "select conv_id, turn, trim(text, ' ' || chr(10)) as text from conversations where turn % 4 < 2 and trim(text) <> ''",
    ),
    "stop_phrase_filter": (stop_phrase_filter, f"select doc_id from documents where not ({_SQL_WORDS} or {_SQL_BARE})"),
    "stop_phrase_many": (stop_phrase_many, _SQL_MANY),
    "stop_phrase_joined": (stop_phrase_joined, _SQL_MANY),
    "echo_strip": (echo_strip, f"select conv_id, turn, once, twice from ({_sql_clean_twice(_SQL_ECHOED, 'raw').replace('* exclude (once), ', '*, ', 1)})"),
    "sentence_cap": (
        sentence_cap,
        r"""
  with parts as (
    select doc_id, list_filter(list_transform(
      string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ' || chr(10))),
      lambda s: s <> '') as p from documents)
  select doc_id, len(p) as sentences, array_to_string(p[1:3], ' ') as start from parts""",
    ),
    "parse_date": (
        parse_date,
        r"""
  with r as (
    select o_orderkey, case o_orderkey % 6
      when 0 then strftime(o_orderdate, '%Y%m%d')
      when 1 then year(o_orderdate) || '' || month(o_orderdate) || day(o_orderdate)
      when 2 then strftime(o_orderdate, '%Y-%m-%d')
      when 3 then year(o_orderdate) || '0231'
      when 4 then strftime(o_orderdate, '%Y%m%d') || '0' end as raw from orders),
  p as (select *, regexp_extract(raw, '^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])$', ['y', 'm', 'd']) as e from r)
  select o_orderkey, raw, strftime(try_strptime(
    case when e.y <> '' then e.y || '-' || lpad(e.m, 2, '0') || '-' || lpad(e.d, 2, '0') end, '%Y-%m-%d'), '%Y-%m-%d') as parsed
  from p""",
    ),
    "midpoint": (
        midpoint,
        f"""
  select event_id, greatest(cast(0.2 as double), {_SQL_START} + greatest(cast(0.2 as double),
         greatest(cast(0 as double), {_SQL_END} - {_SQL_START}) / 2)) as mid
  from events""",
    ),
    "time_of_day": (
        time_of_day,
        f"""
  with s as (select event_id, case when event_id % 3 = 0 then floor({_SQL_START}) else {_SQL_START} end as s from events),
  m as (select event_id, cast(trunc(s) as bigint) * 1000000
               + cast(round_even((s - trunc(s)) * cast(1000000 as double), 0) as bigint) as m from s)
  select event_id, case when m % 1000000 = 0 then strftime(make_timestamp(m), '%H:%M:%S')
         else strftime(make_timestamp(m), '%H:%M:%S.%f') end as at
  from m""",
    ),
    "image_path": (
        image_path,
        "select conv_id, turn, 'chunk_images/' || conv_id || '/' || turn || '.jpg' as image_path from conversations",
    ),
    "video_url": (video_url, "select page_id, 'https://youtu.be/' || page_id as url from pages"),
    "embed_url": (
        embed_url,
        """
  select page_id, case when page_id % 6 in (0, 4) then 'https://www.youtube.com/embed/' || page_id
    when page_id % 6 = 1 then 'https://www.youtube.com/embed/x+y' || page_id else '' end as embed_url from pages""",
    ),
    "url_query_value": (
        url_query_value,
        "select page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) as page from pages",
    ),
    "prompt_text": (
        prompt_text,
        """
  select doc_id, 'SYSTEM: Be brief.' || chr(10) || 'USER: Sum up:' || chr(10) || substr(text, 1, 5000) as prompt
  from documents""",
    ),
    "prompt_chat": (
        prompt_chat,
        """
  select conv_id, turn, '<system>Be brief.</>' || chr(10) || '<user>Sum up:' || chr(10) || substr(text, 1, 5000)
         || '</>' || chr(10) || '<assistant>' as prompt
  from conversations""",
    ),
    "blank_placeholder": (
        blank_placeholder,
        """
  select conv_id || '-' || turn as video_id, '(내용 없음)' as summary_text,
         'https://youtu.be/' || conv_id || '-' || turn as video_url from conversations""",
    ),
    "vector_json_roundtrip": (
        vector_json_roundtrip,
        """
  select vec_id, cast(generate_subscripts(embedding, 1) - 1 as integer) as pos,
         unnest(cast(embedding as double[])) as value from embeddings""",
    ),
    "vector_text_parse": (
        vector_text_parse,
        """
  select event_id, cast(case event_id % 8 when 0 then 3 when 6 then 1 end as bigint) as elements,
         case event_id % 8 when 0 then value when 6 then cast(0 as double) end as first from events""",
    ),
}
