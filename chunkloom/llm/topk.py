"""Exact top-k search by integer inner product.

Tiled matrix products: queries go to blocks and candidates to shards of bounded
size, and each pair of a block and a shard is one product in one task. A tile
keeps k rows per query by partial selection; the short lists of a query meet in a
tree of small merges. A block of queries is copied to each shard and a shard to
each block, so no side has to fit into one task or the driver.

Vectors that are null, or hold a null or a component that is not finite, and rows
without an id take no part. Vectors of different lengths have no inner product
and do not meet. A query meets no row of its own id. Equal scores go to the
smaller id, repeated rows count each. Products beyond 64 bits end at the limits
of a long. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.llm.tables import blocks_for

QUERY_BLOCK = 4096
SHARD = 32768
FAN_IN = 16
STEP = 512  # queries that are multiplied at once: bounds the product of a tile
EXACT = 2**53
LONG = 2**63


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Rows as (vec_id, v) that take part."""
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .filter(finite)
    )


def matrix(column: pa.ChunkedArray, dim: int, scale: float) -> np.ndarray:
    """floor(scale * x) of vectors of one length, as whole-valued doubles."""
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.astype(np.float64)).reshape(len(lists), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: doubles where these are exact, else Python's integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for i, row in enumerate(a):
        left = [int(x) for x in row]
        for j, right in enumerate(whole):
            out[i, j] = min(max(sum(x * y for x, y in zip(left, right)), -LONG), LONG - 1)
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    # ~x instead of -x: the least long has no negative.
    return keep[np.lexsort((ids[keep], ~scores[keep]))][:k]


def _tile(k: int, scale: float):
    schema = pa.schema([("query_id", pa.int64()), ("shard", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        dim, shard = key[0].as_py(), key[2].as_py()
        if not len(left) or not len(right):
            return schema.empty_table()
        queries, ids = left["query_id"].to_numpy(), right["vec_id"].to_numpy()
        a, b = matrix(left["q"], dim, scale), matrix(right["v"], dim, scale)
        out = []
        for at in range(0, len(a), STEP):
            for query, scores in zip(queries[at : at + STEP], products(a[at : at + STEP], b)):
                others = np.flatnonzero(ids != query)
                at_best = others[best(scores[others], ids[others], k)]
                out.append((np.full(len(at_best), query), ids[at_best], scores[at_best]))
        columns = [np.concatenate(x) for x in zip(*out)]
        return pa.table([columns[0], np.full(len(columns[0]), shard, dtype=np.int32), *columns[1:]], schema=schema)

    return run


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: float = 1024.0,
    id_column: str = "vec_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    shard: int = SHARD,
) -> DataFrame:
    """The k best other rows of each query: query_id, rank, vec_id, score.

    `is_query` is a condition on the column vec_id. Counts the rows in a job of its
    own, to fix the number of blocks and shards.
    """
    rows = usable(vectors, id_column, vector)
    counts = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    n_blocks, n_shards = blocks_for(counts.q, query_block), blocks_for(counts.n, shard)
    # A row's place comes from its values: repeated ids are one vector or few, and
    # equal vectors with different ids spread.
    keyed = rows.withColumn("dim", F.size("v")).withColumn("h", F.xxhash64("vec_id", "v"))
    place = lambda n: F.pmod(F.col("h"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (
        keyed.filter(is_query)
        .select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "dim", place(n_blocks).alias("block"))
        .withColumn("shard", every(n_shards))
    )
    right = keyed.withColumn("shard", place(n_shards)).withColumn("block", every(n_blocks))
    keys = ["dim", "block", "shard"]
    tops = (
        left.groupBy(*keys)
        .cogroup(right.drop("h").groupBy(*keys))
        .applyInArrow(_tile(k, scale), "query_id bigint, shard int, vec_id bigint, score bigint")
    )
    order = [F.col("score").desc(), "vec_id"]
    while n_shards > 1:
        tops = tops.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int"))
        ranked = F.row_number().over(W.partitionBy("query_id", "shard").orderBy(*order))
        tops = tops.withColumn("rank", ranked).filter(F.col("rank") <= k).drop("rank")
        n_shards = blocks_for(n_shards, FAN_IN)
    ranked = F.row_number().over(W.partitionBy("query_id").orderBy(*order))
    return tops.select("query_id", ranked.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
