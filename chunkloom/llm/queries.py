"""The queries of this package over the driver tables, and the SQL of those that SQL can express."""

import public_tokenizers
from pyspark.sql import functions as F

from chunkloom.llm import bpe, decontamination, jaccard_join, licenses, line_dedup, packing, ppm, sharding, spelling, suffix_dedup, topk, toxicity, whitening
from chunkloom.llm.tables import fold, read


VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PACKED_VOCABULARY = "byte_bpe_50k.json"


def op1_bpe(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.digests(bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)).drop("text")


def op2_suffix_dedup(spark, folder):
    done = suffix_dedup.dedup(read(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_ppm(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", (fold("doc_id", 7) == 2).alias("held_out"))
    return ppm.score(docs, ppm.fit(docs, ~F.col("held_out"))).drop("text")


def op4_exact_topk(spark, folder):
    return topk.exact_top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


OP4_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]))::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v))
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 10
"""

def op5_sharding(spark, folder):
    return sharding.assign(read(spark, folder, "documents").select("doc_id", "text"), shards=40)


def op6_jaccard_join(spark, folder):
    return jaccard_join.components(read(spark, folder, "documents"), jaccard_join.Rule(words=3, percent=90))


def op7_licenses(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = licenses.scan(docs)
    return found.select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.size("matches").cast("bigint").alias("n_matches"),
        F.coalesce(F.array_max(F.transform("matches", lambda x: x.dice)), F.lit(0.0)).alias("best_dice"),
    )


def op8_decontamination(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find(docs, read(spark, folder, "benchmark"), window=10)
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x.end - x.start)
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP8_SQL = f"""
with i as (select item_id, {WORDS} as w from benchmark where text is not null),
iw as (select distinct item_id, least(10, len(w)) as m, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') as g
  from (select item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as s from i where len(w) > 0)),
d as (select doc_id, {WORDS} as w from documents),
dg as (select doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') as g
  from (select doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) as s from d, (select distinct m from iw))),
found as (select doc_id, item_id, s, m from dg join iw using (m, g)),
hit as (select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(generate_series(s, s + m - 1)) as p from found) group by doc_id),
ids as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct doc_id, item_id from found) group by doc_id)
select doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join hit using (doc_id) left join ids using (doc_id)
"""

def op9_line_dedup(spark, folder):
    done = line_dedup.dedup(read(spark, folder, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.size("removed").cast("bigint").alias("n_chunks"),
        F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("kept_sha256"),
    )


OP9_SQL = """
with d as (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null),
l as (select doc_id, i - 1 as i, ls[i] as line, ('0x' || left(md5(ls[i]), 8))::bigint as h, len(ls) as n
  from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as i from d)),
b as (select *, (i = n - 1 or (h * 1000003 + coalesce(lag(h) over (partition by doc_id order by i), 0)) % 2147483647 % 3 = 0)::int as ends
  from l),
c as (select *, coalesce(sum(ends) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as chunk from b),
k as (select doc_id, chunk, min(i) as start, count(*) as lines, string_agg(line, chr(10) order by i) as text
  from c group by doc_id, chunk having count(*) >= 2 and count(*) filter (trim(line) <> '') >= 2),
r as (select doc_id, chunk, lines from k qualify row_number() over (partition by text order by doc_id, start) > 1),
kept as (select c.doc_id, string_agg(line, chr(10) order by i) as text from c anti join r using (doc_id, chunk) group by c.doc_id)
select documents.doc_id, coalesce(len(ls), 0)::bigint as n_lines, coalesce(gone.lines, 0)::bigint as n_removed,
  coalesce(gone.chunks, 0)::bigint as n_chunks, sha256(coalesce(kept.text, '')) as kept_sha256
from documents left join d using (doc_id) left join kept using (doc_id)
  left join (select doc_id, sum(lines) as lines, count(*) as chunks from r group by doc_id) gone using (doc_id)
"""


def op10_toxicity(spark, folder):
    docs = read(spark, folder, "documents")
    model = toxicity.train(docs, read(spark, folder, "labels").filter(fold("doc_id", 3) != 1))
    scored = toxicity.classify(docs.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        (F.col("score") >= F.col("threshold")).cast("int").alias("predicted_by_lang"),
    )


def op11_whitening(spark, folder):
    vectors = read(spark, folder, "embeddings")
    done = whitening.transform(vectors, whitening.fit(vectors, most=32))
    return done.select(
        "vec_id",
        "n",
        "deviation",
        "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "own"),
    ).select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "own.whitened", "own.explained", "identity_error")


def op12_spelling(spark, folder):
    return spelling.variants(read(spark, folder, "documents"), shortest=7, fewest=2, ratio=10)


def op13_packing(spark, folder):
    vocabulary = packing.read_vocabulary(public_tokenizers.path(PACKED_VOCABULARY))
    packed = packing.pack(read(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN, size=1024)
    return packed.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


_LITERAL = ", ".join("('{}', {}, '{}')".format(n, i, b.replace("'", "''")) for i, (n, b) in enumerate(sorted(licenses.TEMPLATES)))
OP7_SQL = f"""
with u as (select doc_id, 'line' as kind, unnest(string_split(text, chr(10))) as text, unnest(range(len(string_split(text, chr(10))))) as nth from documents
  union all
  select * from (select doc_id, 'paragraph' as kind, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) as text,
    unnest(range(len(regexp_split_to_array(text, '\n[ \t]*\n')))) as nth from documents) where contains(text, chr(10))
  union all
  select doc_id, 'text', text, 0 from documents where len(regexp_split_to_array(text, '\n[ \t]*\n')) > 1),
t as (select name, template, {WORDS} as w from (values {_LITERAL}) as x(name, template, text)),
tg as (select name, template, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g from t),
ug as (select doc_id, kind, nth, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g
  from (select doc_id, kind, nth, {WORDS} as w from u) where len(w) >= 2),
near as (select * from ug where len(list_intersect(g, (select list_distinct(flatten(list(g))) from tg))) > 0),
scored as (select doc_id, kind, nth, name, template, 2 * len(list_intersect(near.g, tg.g)) / (len(near.g) + len(tg.g)) as dice
  from near join tg on len(tg.g) > 0 where 2 * least(len(near.g), len(tg.g)) >= 0.8 * (len(near.g) + len(tg.g))),
best as (select * from scored where dice >= 0.8
  qualify row_number() over (partition by doc_id, kind, nth order by dice desc, template) = 1),
per as (select doc_id, string_agg(distinct name, ',' order by name) as licenses, count(*) as n, max(dice) as dice from best group by doc_id)
select documents.doc_id, coalesce(licenses, '') as licenses, coalesce(n, 0)::bigint as n_matches, coalesce(dice, 0)::double as best_dice
from documents left join per using (doc_id)
"""

PAIRS = {
    "op2_suffix_dedup": (op2_suffix_dedup, None),
    "op3_ppm": (op3_ppm, None),
    "op6_jaccard_join": (op6_jaccard_join, None),
    "op7_licenses": (op7_licenses, OP7_SQL),
    "op9_line_dedup": (op9_line_dedup, OP9_SQL),
    "op5_sharding": (op5_sharding, None),
    "op1_bpe": (op1_bpe, None),
    "op10_toxicity": (op10_toxicity, None),
    "op8_decontamination": (op8_decontamination, OP8_SQL),
    "op4_exact_topk": (op4_exact_topk, OP4_SQL),
    "op11_whitening": (op11_whitening, None),
    "op12_spelling": (op12_spelling, None),
    "op13_packing": (op13_packing, None),
}


def queries():
    return {name: run for name, (run, _) in PAIRS.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in PAIRS.items() if sql}
