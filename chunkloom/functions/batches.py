"""Vector arithmetic on Arrow batches.

Spark's array functions go through a vector element by element, at some 200 ns
each; on a batch as a matrix the same work takes a few. Only the vectors leave
the JVM, and partial sums or one number per row come back.
"""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from chunkloom.fixed_values import MIN_NORM

# Sent along with each job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Rows are worked on in blocks of about this many elements, which stay in the processor's cache.
_BLOCK_ELEMENTS = 1 << 17


class _Rows:
    """The vectors of a batch; blocks of equally long ones are given out as matrices."""

    def __init__(self, vectors: pa.Array):
        self.lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
        # A null element comes out as NaN.
        self._flat = vectors.flatten().to_numpy(zero_copy_only=False)
        self._starts = np.cumsum(self.lengths) - self.lengths

    def matrix(self, rows: np.ndarray, length: int) -> np.ndarray:
        start = self._starts[rows[0]]
        if self._starts[rows[-1]] - start == (len(rows) - 1) * length:
            flat = self._flat[start : start + len(rows) * length].reshape(-1, length)
        else:
            flat = self._flat[self._starts[rows][:, None] + np.arange(length)]
        return flat.astype(np.float64, copy=False)


def _by_length(lengths: np.ndarray):
    """(length, row numbers in ascending order) for all rows that are not empty."""
    for length in np.unique(lengths[lengths > 0]):
        yield int(length), np.flatnonzero(lengths == length)


def _blocks(rows: np.ndarray, length: int):
    step = max(1, _BLOCK_ELEMENTS // length)
    for first in range(0, len(rows), step):
        yield slice(first, first + step)


def _norms(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are finite, and the lengths to divide by."""
    with np.errstate(over="ignore", invalid="ignore"):
        squares = np.einsum("ij,ij->i", matrix, matrix)
    return np.isfinite(squares), np.clip(np.sqrt(squares), MIN_NORM, None)


def _add_rows(sums: np.ndarray, counts: np.ndarray, places: np.ndarray, matrix: np.ndarray) -> None:
    """Add each row of the matrix to the sum at its place."""
    if (places[1:] < places[:-1]).any():
        order = np.argsort(places, kind="stable")
        places, matrix = places[order], matrix[order]
    distinct, starts, n = np.unique(places, return_index=True, return_counts=True)
    sums[distinct] += np.add.reduceat(matrix, starts, axis=0)
    counts[distinct] += n


def partial_sums(batches):
    """(video_id, vector) batches to (video_id, size, n, total): sums of unit vectors per video and size.

    Rows without a usable vector are counted with size 0 and no total.
    """
    for batch in batches:
        videos = batch.column(0).dictionary_encode(null_encoding="encode")
        codes = videos.indices.to_numpy(zero_copy_only=False)
        vectors = _Rows(batch.column(1))
        unusable = np.ones(len(codes), dtype=bool)
        for length, rows in _by_length(vectors.lengths):
            distinct, places = np.unique(codes[rows], return_inverse=True)
            sums, counts = np.zeros((len(distinct), length)), np.zeros(len(distinct), dtype=np.int64)
            for block in _blocks(rows, length):
                matrix = vectors.matrix(rows[block], length)
                finite, norms = _norms(matrix)
                if finite.any():
                    unit = matrix[finite] / norms[finite, None]
                    _add_rows(sums, counts, places[block][finite], unit)
                    unusable[rows[block][finite]] = False
            summed = counts > 0
            offsets = np.arange(summed.sum() + 1, dtype=np.int32) * length
            totals = pa.ListArray.from_arrays(offsets, sums[summed].ravel())
            yield _sums(videos, distinct[summed], length, counts[summed], totals)
        if unusable.any():
            distinct, counts = np.unique(codes[unusable], return_counts=True)
            yield _sums(videos, distinct, 0, counts, pa.nulls(len(distinct), pa.list_(pa.float64())))


def _sums(videos, distinct, length, counts, totals) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            videos.dictionary.take(pa.array(distinct)),
            pa.array(np.full(len(distinct), length, dtype=np.int32)),
            pa.array(counts.astype(np.int64)),
            totals,
        ],
        names=["video_id", "size", "n", "total"],
    )


def _of_usable(vector: pa.Array, change) -> pa.Array:
    """Each usable vector with `change` applied to blocks (matrix, norms) of them; null for the others."""
    held = _Rows(vector)
    out = np.full(len(vector), None, dtype=object)
    for length, rows in _by_length(held.lengths):
        for block in _blocks(rows, length):
            at = rows[block]
            matrix = held.matrix(at, length)
            finite, norms = _norms(matrix)
            for i, row in zip(at[finite], change(matrix[finite], norms[finite, None])):
                out[i] = row
    return pa.array(out, pa.list_(pa.float64()))


@F.arrow_udf(ArrayType(DoubleType()))
def usable(vector: pa.Array) -> pa.Array:
    """The vector as doubles; null where it is empty or holds a null or an element that is not finite."""
    return _of_usable(vector, lambda matrix, norms: matrix)


@F.arrow_udf(ArrayType(DoubleType()))
def unit(vector: pa.Array) -> pa.Array:
    """The usable vector divided by its length."""
    return _of_usable(vector, lambda matrix, norms: matrix / norms)


@F.arrow_udf(DoubleType())
def cosine_to(vector: pa.Array, centroid: pa.Array) -> pa.Array:
    """Unit vector times centroid; null unless the vector is usable and as long as the centroid."""
    left, right = _Rows(vector), _Rows(centroid)
    result = np.zeros(len(vector))
    known = np.zeros(len(vector), dtype=bool)
    for length, rows in _by_length(np.where(left.lengths == right.lengths, left.lengths, 0)):
        for block in _blocks(rows, length):
            at = rows[block]
            matrix = left.matrix(at, length)
            finite, norms = _norms(matrix)
            with np.errstate(over="ignore", invalid="ignore"):
                result[at] = np.einsum("ij,ij->i", matrix, right.matrix(at, length)) / norms
            known[at] = finite
    return pa.array(result, mask=~known)
