"""Line dedup with content-defined chunks, in DataFrame operations only.

A text is cut into chunks of lines. A rolling hash over the hashes of the last two
lines decides whether a chunk ends, so that boundaries follow the content: after an
insertion they fall into step again within two lines. Chunks of several lines that
occur more than once, anywhere, are removed but for their first occurrence (the
smallest document id, then the earliest line).

Counting groups by the bytes of the chunks and combines on the map side. Each
occurrence finds its chunk by a hash, and is removed only after its bytes have been
compared. A chunk needs two lines that are not blank; single lines, and chunks that
occur once, stay.

A null text has no lines and stays null; an empty text has one empty line. A null id
counts as the smallest. Rows of one id are not compared with each other but for
repeated chunks within a row, so exact copies of a row all stay as they are or all
change alike. Other columns stay; the four result columns replace columns of their
names. An empty table gives no rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.scratch import cut
from chunkloom.llm.tables import own_names

MEAN_LINES = 3
PRIME = 2147483647
BASE = 1000003
RESULTS = ["n_lines", "n_removed", "removed", "clean_text"]


def held(df: DataFrame, **columns) -> DataFrame:
    """Adds columns through a generator of one row.

    The functions that use them inside lambdas then read finished arrays; plain
    projections would be merged and compute an array again for each of its elements.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_lines(docs: DataFrame, text: str) -> DataFrame:
    return held(docs, _lines=F.split(F.col(text), "\n", -1))


def line_hash(line):
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("bigint")


def chunks(docs: DataFrame, keys: list[str], text: str, mean_lines: int) -> DataFrame:
    """Chunk rows of several lines: the keys, first, n, chunk, and whether the same text came earlier in the row."""
    rows = with_lines(docs.select(*keys, text).filter(F.col(text).isNotNull()), text)
    rows = held(rows.drop(text), _hashes=F.transform("_lines", line_hash))
    rolling = lambda i: F.get("_hashes", i - 1) * F.lit(BASE) + F.coalesce(F.get("_hashes", i - 2), F.lit(0))
    ends = F.filter(
        F.sequence(F.lit(1), F.size("_hashes")),
        lambda i: (i == F.size("_hashes")) | (F.pmod(rolling(i), F.lit(PRIME)) % mean_lines == 0),
    )
    rows = held(rows, _ends=ends).drop("_hashes")
    first = lambda i: F.coalesce(F.get("_ends", i - 1), F.lit(0))
    spans = F.transform("_ends", lambda end, i: F.struct(first(i).alias("first"), (end - first(i)).alias("n")))
    rows = held(rows, _spans=F.filter(spans, lambda s: s.n >= 2)).drop("_ends")
    own = lambda s: F.slice("_lines", s.first + 1, s.n)
    texts = F.transform("_spans", lambda s: F.struct(F.array_join(own(s), "\n").alias("chunk"), s.first.alias("first"), s.n.alias("n")))
    full = F.filter("_spans", lambda s: F.size(F.filter(own(s), lambda x: F.trim(x) != "")) >= 2)
    rows = held(rows.withColumn("_spans", full), _texts=F.array_sort(texts))
    rows = rows.select(
        *keys,
        F.inline(F.transform("_texts", lambda x, i: F.struct(
            x["chunk"].alias("chunk"), x["first"].alias("first"), x["n"].alias("n"),
            F.coalesce(F.get("_texts", i - 1)["chunk"] == x["chunk"], F.lit(False)).alias("again"),
        ))),
    )
    return rows.withColumn("hash", F.xxhash64("chunk"))


@own_names("id_column", "text")
def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", mean_lines: int = MEAN_LINES) -> DataFrame:
    """Rows with n_lines, n_removed (lines), removed (spans of line numbers) and clean_text.

    Writes the repeated chunks to the scratch folder.
    """
    low = F.lit(-(2**63)).cast("bigint")
    keyed = docs.withColumns({"_id": F.coalesce(F.col(id_column).cast("bigint"), low), "_text": F.xxhash64(text)})
    found = chunks(keyed, ["_id", "_text"], text, mean_lines)
    repeated = cut(
        found.groupBy("hash", "chunk").agg(F.count("*").alias("times"), F.min("_id").alias("first_id")).filter("times > 1").drop("times"),
        "repeated-chunks",
    )
    light = found.select("_id", "_text", "hash", "first", "n", "again")
    hits = light.join(repeated, "hash").filter(F.col("again") | (F.col("_id") > F.col("first_id")))
    # Repeated rows give the same hits several times.
    of_row = hits.groupBy("_id", "_text").agg(F.array_sort(F.collect_set(F.struct("first", "n", "chunk"))).alias("_hits"))
    rows = with_lines(keyed.drop(*RESULTS).join(of_row, ["_id", "_text"], "left"), text)
    same = F.filter("_hits", lambda x: F.array_join(F.slice("_lines", x["first"] + 1, x["n"]), "\n") == x["chunk"])
    removed = F.transform(same, lambda x: F.struct(x["first"].alias("first"), x["n"].alias("n")))
    rows = held(rows.drop("_id", "_text"), removed=F.coalesce(removed, F.array().cast("array<struct<first:int,n:int>>")))
    begin = lambda i: F.coalesce(F.get("removed", i - 1)["first"] + F.get("removed", i - 1)["n"], F.lit(0))
    end = lambda i: F.coalesce(F.get("removed", i)["first"], F.size("_lines"))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("removed")), lambda i: F.slice("_lines", begin(i) + 1, end(i) - begin(i))))
    return rows.select(
        *[c for c in docs.columns if c not in RESULTS],
        F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, x: n + x["n"]).alias("n_removed"),
        "removed",
        F.when(F.size("removed") == 0, F.col(text)).otherwise(F.array_join(kept, "\n")).alias("clean_text"),
    )
