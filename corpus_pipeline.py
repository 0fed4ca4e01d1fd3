"""Five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the next stage's docs. All but the last return the columns of
documents. Rows with null ids pass every stage but the near-duplicate links; null texts
pass all stages as empty ones.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm import bpe, decontamination, jaccard_join, line_dedup, toxicity
from chunkloom.llm.scratch import cut
from chunkloom.llm.tables import read

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NEAR = jaccard_join.Rule(words=5, percent=80)
WINDOW = 10
# Numbers that are left for earlier texts on one side of all ids.
ROOM = 1 << 62


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of their language."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model).filter(F.col("score") < F.col("threshold")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that came earlier; a document that loses all its lines goes."""
    done = line_dedup.dedup(docs).filter((F.col("n_removed") < F.col("n_lines")) | (F.col("n_lines") == 0))
    changed = done.withColumns({"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("bigint")})
    return changed.select(*docs.columns)


def grouped(docs: DataFrame, before: DataFrame) -> DataFrame:
    """(doc_id, component_id) over the texts of `docs`, and over those of `before` for ids whose text has changed since.

    The earlier texts are compared under numbers beyond all ids, above or below them, since
    rows of one id are one document to the join. Ids may be any 64-bit numbers.
    """
    now, then = (df.select("doc_id", F.xxhash64("text").alias("hash")) for df in (docs.filter("doc_id is not null"), before))
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    nth, others = F.monotonically_increasing_id(), None
    if ends.high is None or ends.high < ROOM:
        number = nth + F.lit(max(0, (ends.high or 0) + 1))
    elif ends.low > -ROOM:
        number = F.lit(min(0, ends.low) - 1) - nth
    else:  # Ids up to both ends leave no room: all documents get numbers, and those of earlier texts lie between them.
        others = cut(docs.filter("doc_id is not null").select("doc_id").distinct().withColumn("number", nth), "numbers")
        others = others.withColumn("number", F.col("number") * 2)
    changed = now.join(then, ["doc_id", "hash"], "left_anti").select("doc_id").distinct()
    if others is None:
        changed = cut(changed.withColumn("number", number), "changed")
        owner = changed
    else:
        changed = cut(changed.join(others, "doc_id").withColumn("number", F.col("number") + 1), "changed")
        owner = changed.unionByName(others)
        docs = docs.join(others, "doc_id", "left").withColumn("doc_id", F.col("number")).drop("number")
    earlier = before.join(changed, "doc_id").select(F.col("number").alias("doc_id"), "text")
    groups = jaccard_join.components(docs.select("doc_id", "text").unionByName(earlier), NEAR)
    owner = owner.select(F.col("doc_id").alias("owner"), F.col("number").alias("doc_id"))
    member = cut(groups.join(owner, "doc_id", "left").select(F.coalesce("owner", "doc_id").alias("doc_id"), "component_id"), "near-copies")
    # Where the smallest number is not that of the smallest document; most components have none to mend.
    head = member.filter("doc_id is not null").groupBy("component_id").agg(F.min("doc_id").alias("head")).filter("head <> component_id")
    return member.join(cut(head, "heads"), "component_id", "left").select("doc_id", F.coalesce("head", "component_id").alias("component_id"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, once.

    What line dedup leaves of a copy no longer resembles the original, so that documents
    it has changed are compared both as they are now and as they were.
    """
    copies = grouped(docs, read(spark, sf_dir, "documents")).filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    kept = docs.join(cut(copies, "copies"), "doc_id", "left_anti")
    repeated = cut(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontamination.find(docs, read(spark, sf_dir, "benchmark"), window=WINDOW)
    return found.filter(F.size("hits") == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with token ids, their number and digest, and the digest of the text that they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    coded = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return bpe.digests(coded.withColumn("token_ids", F.col("ids")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: SQL cannot train the classifier or run the merges; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
