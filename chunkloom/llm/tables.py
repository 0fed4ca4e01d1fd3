"""Reads the tables of the queries, and small helpers that the operators share."""

import functools
import inspect
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def own_names(*parameters: str):
    """For operators docs -> rows whose inner columns begin with an underscore: columns of the caller that do, too, get other names meanwhile.

    `parameters` are those that name a column.
    """

    def wrap(operator):
        signature = inspect.signature(operator)

        @functools.wraps(operator)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            clashing = [c for c in docs.columns if c.startswith("_")]
            if not clashing:
                return operator(docs, *args, **options)
            free = (f"set aside {i}" for i in range(2 * len(docs.columns)))
            aside = dict(zip(clashing, (name for name in free if name not in docs.columns)))
            given = signature.bind(docs.withColumnsRenamed(aside), *args, **options)
            given.apply_defaults()
            for name in parameters:
                given.arguments[name] = aside.get(given.arguments[name], given.arguments[name])
            made = operator(*given.args, **given.kwargs)
            return made.withColumnsRenamed({v: k for k, v in aside.items()})

        return run

    return wrap


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def runs(sizes, most: int):
    """Cuts rows of the given sizes into runs of at most `most` together, or one row: (from, to)."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def text_runs(batch, column: str, most: int):
    """A record batch with a text or binary column, cut into (rows, texts as bytes or None) of bounded size."""
    import pyarrow as pa

    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    sizes = [len(x) if x is not None else 0 for x in texts.to_pylist()] if len(texts) else []
    for start, end in runs(sizes, most):
        yield batch.slice(start, end - start), texts.slice(start, end - start).to_pylist()


def with_columns(batch, **columns):
    """The record batch with columns added at its end."""
    import pyarrow as pa

    for name, values in columns.items():
        batch = batch.append_column(name, values if isinstance(values, pa.Array) else pa.array(values))
    return batch
