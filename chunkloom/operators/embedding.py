"""Text embeddings, by a caller's model or by hashed words."""

from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.guarded import guard

DEFAULT_DIM = 256


def embed(chunks: DataFrame, model=None, dim: int = DEFAULT_DIM) -> DataFrame:
    """Add `embedding` (array<double>) computed from `text`.

    `model` is a pandas UDF from text to array<double>; the iterator form loads
    its weights once per Python worker. Without one, word counts are hashed into
    `dim` places and scaled to length one, inside the JVM.
    """
    if model is not None:
        return chunks.withColumn("embedding", model(F.col("text")).cast("array<double>"))
    # The tokenizer does not take null text.
    filled = chunks.withColumn("_text", F.coalesce("text", F.lit("")))
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"(?U)\s+").transform(filled)
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim).transform(words)
    scaled = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0).transform(counts)
    return scaled.withColumn("embedding", vector_to_array("_unit")).drop(
        "_text", "_words", "_counts", "_unit"
    )


def embed_guarded(chunks: DataFrame, model) -> DataFrame:
    """Like `embed` with a model; where it fails on a text, `embedding` is null and `model_error` tells why."""
    tried = chunks.withColumn("_made", guard(model)(F.col("text")))
    return tried.withColumns({"embedding": F.col("_made.value").cast("array<double>"), "model_error": F.col("_made.error")}).drop("_made")
