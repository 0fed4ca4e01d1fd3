"""Per video, the chunks closest to the mean of its unit vectors."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom import fixed_values as fv
from chunkloom.functions import batches, text, vectors
from chunkloom.session import stored

# A video with more chunks than this has its similarity join split into several tasks.
HOT_ROWS = 200_000
# At most this many videos can be hot, whatever the data, so their list can be broadcast.
MAX_HOT = 100_000
# Up to this k Spark limits each task by itself before it shuffles (spark.sql.optimizer.windowGroupLimitThreshold).
PRUNED_K = 1000
# Beyond, a video is limited in so many parts first.
PARTS = 256


def _best_first():
    return F.desc_nulls_last("sim"), F.asc_nulls_last("chunk_id"), F.col("text")


def vector_sums(chunks: DataFrame, embedding: str) -> DataFrame:
    """(video_id, size, n, total): per batch, video and vector size, how many unit vectors and their sum.

    Rows without a usable vector have size 0 and no total. Vectors are summed as a whole
    rather than element by element, which would multiply the rows by the vector size.
    """
    keyed = chunks.select("video_id", vectors.as_array(chunks, embedding).alias("vector"))
    partial = T.StructType(
        [
            keyed.schema["video_id"],
            T.StructField("size", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.ArrayType(T.DoubleType())),
        ]
    )
    return keyed.mapInArrow(batches.partial_sums, partial)


def merged_sums(sums: DataFrame) -> DataFrame:
    """The same table with one row per video and size. Sums are added per task first, so that a hot video sends one row per task."""
    # Rows without a vector are given a total that is not used.
    total = array_to_vector(F.coalesce("total", F.array(F.lit(0.0))))
    added = sums.groupBy("video_id", "size").agg(F.sum("n").alias("n"), Summarizer.sum(total).alias("total"))
    return added.select("video_id", "size", "n", F.when(F.col("size") > 0, vector_to_array("total")).alias("total"))


def mean_of_sums(sums: DataFrame) -> DataFrame:
    """The table of `centroids` from sums, whether merged or not."""
    by_size = merged_sums(sums).withColumn("n_valid", F.when(F.col("size") > 0, F.col("n")).otherwise(0))
    per_video = by_size.groupBy("video_id").agg(
        F.sum("n").alias("n_rows"),
        F.sum("n_valid").alias("n_vectors"),
        F.count("total").alias("n_sizes"),
        F.first("total", ignorenulls=True).alias("total"),
    )
    mean = F.transform("total", lambda e: e / F.col("n_vectors"))
    return per_video.select(
        "video_id", "n_rows", "n_vectors", "n_sizes", F.when(F.col("n_sizes") == 1, mean).alias("centroid")
    )


def centroids(chunks: DataFrame, embedding: str) -> DataFrame:
    """One row per video: its number of rows, of valid vectors, of vector sizes, and the mean unit vector.

    The null video id is a group like any other. Vectors of different size cannot be added
    and are kept apart by grouping on it.
    """
    return mean_of_sums(vector_sums(chunks, embedding))


def stored_centroids(chunks: DataFrame, embedding: str) -> DataFrame:
    """Runs a job: the centroids as a table of known size, see `session.stored`."""
    return stored(centroids(chunks, embedding), "centroids")


def vector_rejects(table: DataFrame) -> DataFrame:
    """Videos whose vectors differ in size; no mean exists for them."""
    return table.filter(F.col("n_sizes") > 1).select("video_id", "n_rows", "n_vectors", "n_sizes")


def _hot_salts(table: DataFrame, hot_rows: int, max_hot: int) -> DataFrame | None:
    """(video_id, salts) of the videos too large for one task, or None. Reads one row of totals."""
    total, largest = table.agg(F.sum("n_rows"), F.max("n_rows")).first()
    limit = max(hot_rows, (total or 0) // max_hot)
    if (largest or 0) <= limit:
        return None
    salts = F.ceil(F.col("n_rows") / F.lit(limit)).cast("int").alias("salts")
    return table.filter(F.col("n_rows") > limit).select("video_id", salts)


def _join_centroids(chunks: DataFrame, table: DataFrame, hot_rows: int, max_hot: int) -> DataFrame:
    """Each chunk with the centroid of its video, null ids included.

    Chunks of a hot video are spread over several join keys and its centroid is
    repeated for each of them; all other videos keep one.
    """
    hot = _hot_salts(table, hot_rows, max_hot)
    side = table.select(F.col("video_id").alias("_id"), "centroid", "n_sizes")
    if hot is None:
        return chunks.join(side, chunks["video_id"].eqNullSafe(side["_id"])).drop("_id")
    hot = F.broadcast(hot.withColumnRenamed("video_id", "_hot"))
    spread = (
        chunks.join(hot, chunks["video_id"].eqNullSafe(hot["_hot"]), "left")
        .withColumn("_salt", F.pmod(F.xxhash64("chunk_id", "text"), F.coalesce("salts", F.lit(1))))
        .drop("_hot", "salts")
    )
    repeated = (
        side.join(hot, side["_id"].eqNullSafe(hot["_hot"]), "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        .drop("_hot", "salts")
    )
    same = spread["video_id"].eqNullSafe(repeated["_id"]) & (spread["_salt"] == repeated["_part"])
    return spread.join(repeated, same).drop("_id", "_salt", "_part")


def similarities(
    chunks: DataFrame, table: DataFrame, embedding: str, hot_rows: int = HOT_ROWS, max_hot: int = MAX_HOT
) -> DataFrame:
    """(video_id, chunk_id, text, n_sizes, sim): unit vector times centroid, null without a valid vector."""
    vector = vectors.as_array(chunks, embedding).alias("vector")
    joined = _join_centroids(chunks.select("video_id", "chunk_id", "text", vector), table, hot_rows, max_hot)
    sim = batches.cosine_to(F.col("vector"), F.col("centroid"))
    return joined.select("video_id", "chunk_id", "text", "n_sizes", sim.alias("sim"))


def _first_k(scored: DataFrame, k: int) -> DataFrame:
    """The k best rows per video, equal ones in chunk order.

    The filter on the row number lets Spark keep k rows per video and task
    before it shuffles, so a hot video does not end up whole in one task. It does
    so for small k only; see `_first_many` for others.
    """
    if k > PRUNED_K:
        return _first_many(scored, k)
    ranked = F.row_number().over(Window.partitionBy("video_id").orderBy(*_best_first()))
    return scored.withColumn("_rank", ranked).filter(F.col("_rank") <= k)


def _first_many(scored: DataFrame, k: int) -> DataFrame:
    """Like `_first_k` in two limits: over parts of each video, then over what these leave.

    Equal rows are counted first, so that they need no part of their own.
    """
    rows = scored.groupBy("video_id", "chunk_id", "text", "sim", "n_sizes").agg(F.count("*").alias("_times"))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("chunk_id", "text", "sim"), F.lit(PARTS)))
    for keys in (["video_id", "_part"], ["video_id"]):
        until = Window.partitionBy(*keys).orderBy(*_best_first()).rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_before", F.sum("_times").over(until) - F.col("_times")).filter(F.col("_before") < k)
    copies = F.least("_times", F.lit(k) - F.col("_before"))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies))).drop("_times", "_part", "_before", "_copy")


def top_chunks(
    chunks: DataFrame,
    k: int = fv.TOP_K,
    embedding: str | None = None,
    table: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """(video_id, chunk_id, text) of the k chunks closest to their video's centroid.

    A video without any valid vector gives its first k chunks. Where some are
    valid, the chunks without one are left out. Videos whose vectors differ in
    size are left out whole, see `vector_rejects`. With an embedding column and
    no `table` of centroids given, runs the job of `stored_centroids`.
    """
    chunks = chunks.select(
        "video_id", "chunk_id", text.or_empty(F.col("text")).alias("text"), *([embedding] if embedding else [])
    )
    if embedding is None:
        scored = chunks.withColumns({"sim": F.lit(None).cast("double"), "n_sizes": F.lit(0)})
    else:
        if table is None:
            table = stored_centroids(chunks, embedding)
        scored = similarities(chunks, table, embedding, hot_rows, max_hot)
    best = _first_k(scored.filter(F.col("n_sizes") <= 1), k)
    return best.filter((F.col("n_sizes") == 0) | F.col("sim").isNotNull()).select("video_id", "chunk_id", "text")


def in_chunk_order(chunks: DataFrame) -> DataFrame:
    """Sorted by video and chunk, nulls last."""
    return chunks.orderBy(F.col("video_id").asc_nulls_last(), F.col("chunk_id").asc_nulls_last())


def contexts(picked: DataFrame) -> DataFrame:
    """(video_id, context): the picked texts of each video in chunk order, one per line."""
    joined = F.expr("listagg(text, '\\n') within group (order by chunk_id asc nulls last, text)")
    return picked.groupBy("video_id").agg(joined.alias("context"))
