"""Whitening of embeddings by a bidiagonal qd solver.

Each component c of a vector becomes the whole number x = floor(scale * c) + shift. A first
pass sums x per dimension. A second one centres the rows, (n * x - S) / n with an exact
difference, and reduces blocks of them to triangular factors by QR; the factors of tasks are
reduced by QR again, FAN_IN at a time, until one R is left with R'R = n * covariance. Householder
reflections bring R to a bidiagonal B, dqds finds its singular values to high relative
accuracy, twisted factorisations of B'B find their vectors, and the reflections turn these
into directions. Nothing squares the data: the covariance is never formed.

Singular values closer together than CLUSTER of their size hardly tell their vectors apart: the
later ones of such a cluster are taken through inverse iteration, kept orthogonal to the earlier.
A direction in which the rows do not
vary beyond rounding has no whitened values and is left out, as are all of a single row.

Rows whose vector is null or holds null or non-finite entries take no part, rows with a null
id do. Vectors of another length are a fit of their own: they share no dimension. x beyond a
long stops at its limits, as Spark's cast does; a deviation beyond a long is the largest long.
Repeated rows count each. An empty table gives an empty result. Only the id and the vector
are read, so other columns may have any names. What reaches the driver does not grow with the
rows: an R and the directions, for each length of vectors.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.scratch import cut

BLOCK = 4096
FAN_IN = 16
#: Triangular factors that are reduced at once take so many bytes at most, but are two at least.
FAN_BYTES = 1 << 28
CLUSTER = 1e-5
EPS = np.finfo(np.float64).eps
LONG = 2**63


class Model(NamedTuple):
    """The fit of the vectors of one length; directions are columns, by falling variance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    total: float

    def identity_error(self, factor: np.ndarray) -> float:
        """Largest entry of the covariance of the whitened rows minus the identity; `factor` is R."""
        white = factor @ (self.directions / np.sqrt(self.variances)) / np.sqrt(self.n)
        return float(np.abs(white.T @ white - np.eye(white.shape[1])).max(initial=0.0))


class Fit(NamedTuple):
    scale: float
    shift: int
    models: dict[int, Model]
    identity_error: dict[int, float]


def whole(flat: np.ndarray, scale: float, shift: int) -> np.ndarray:
    """floor(scale * c) + shift as longs, stopping at a long's limits."""
    moved = np.floor(scale * flat.astype(np.float64)) + shift
    inner = np.clip(moved, -float(LONG), np.nextafter(float(LONG), 0))
    return np.where(moved >= LONG, LONG - 1, inner.astype(np.int64))


def householder(column: np.ndarray) -> tuple[np.ndarray, float]:
    """v of length one and a with (1 - 2vv')column = a * e1."""
    scale = np.abs(column).max(initial=0.0)
    if scale == 0.0:
        return np.zeros_like(column), 0.0
    v = column / scale
    norm = np.sqrt(v @ v)
    a = -norm if v[0] >= 0 else norm
    v = v.copy()
    v[0] -= a
    length = np.sqrt(v @ v)
    return (v / length if length else v), a * scale


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B with r = U B V', and V."""
    a = np.array(r, dtype=np.float64)
    d = a.shape[1]
    right = np.eye(d)
    diagonal, upper = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        v, diagonal[k] = householder(a[k:, k])
        a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        if k < d - 1:
            v, upper[k] = householder(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2.0 * np.outer(right[:, k + 1 :] @ v, v)
    return diagonal, upper, right


def _dqds_step(q: np.ndarray, e: np.ndarray, shift: float):
    """One transform with a shift, or None where it would leave the positive numbers."""
    n = len(q)
    q2, e2 = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        q2[i] = d + e[i]
        if d < 0.0 or not q2[i] > 0.0:
            return None
        ratio = q[i + 1] / q2[i]
        e2[i] = e[i] * ratio
        d = d * ratio - shift
    q2[n - 1] = d
    return None if d < 0.0 else (q2, e2)


def _zero_row(q: list, e: list):
    """A transform without shift of an array that holds a zero, which it moves to the end; the next one splits it off."""
    n = len(q)
    d = q[0]
    q2, e2 = [0.0] * n, [0.0] * (n - 1)
    for i in range(n - 1):
        q2[i] = d + e[i]
        ratio = q[i + 1] / q2[i] if q2[i] > 0.0 else 0.0
        e2[i] = e[i] * ratio
        d = d * ratio if q2[i] > 0.0 else q[i + 1]
    q2[n - 1] = d
    return np.array(q2), np.array(e2)


def singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Singular values of a bidiagonal matrix by dqds, falling.

    A part of the array is worked on at its end: what is left of its shift is its smallest
    value, which is then split off. Shifts come from the last two rows and are halved when they
    prove too large, and end at none, which cannot fail.
    """
    q, e = np.square(diagonal), np.square(upper)
    scale = max(q.max(initial=0.0), e.max(initial=0.0))
    if scale == 0.0:
        return np.zeros(len(q))
    todo, found = [(q / scale, e / scale, 0.0)], []
    tiny = EPS * EPS
    while todo:
        q, e, sigma = todo.pop()
        while len(q):
            n = len(q)
            if n == 1:
                found.append(sigma + q[0])
                break
            if e[-1] <= tiny * (sigma + q[-1]) or e[-1] <= np.finfo(np.float64).tiny:
                found.append(sigma + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            small = np.flatnonzero(e <= tiny * (sigma + q[1:]))
            if len(small):
                at = int(small[-1])
                todo.append((q[: at + 1], e[:at], sigma))
                q, e = q[at + 1 :], e[at + 1 :]
                continue
            if not (q > 0.0).all():
                q, e = _zero_row(q.tolist(), e.tolist())
                continue
            # The smaller eigenvalue of the last two rows, below the last q.
            half = 0.5 * (q[-2] + e[-2] if n > 2 else q[-2]) + 0.5 * (q[-1] + e[-1])
            product = q[-2] * q[-1]
            root = np.sqrt(max(half * half - product, 0.0))
            shift = 0.98 * min(product / (half + root), q[-1], q.min())
            done = None
            while done is None:
                done = _dqds_step(q, e, shift)
                if done is None:
                    shift = shift / 4 if shift > tiny * q[-1] else 0.0
            q, e = done
            sigma += shift
    return np.sqrt(np.sort(np.array(found))[::-1] * scale)


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """The eigenvector of B'B at `value`, by the twisted factorisation with the smallest pivot.

    B'B = L D L' with pivots diagonal^2 and multipliers upper / diagonal. The stationary
    transform factors from the top, the progressive one from the bottom; they meet where the
    pivot is smallest, and the vector follows from there by multiplications alone.
    """
    n = len(diagonal)
    floor = EPS * EPS * (np.square(diagonal).max(initial=0.0) + value) + np.finfo(np.float64).tiny
    d = np.square(diagonal)
    d = np.where(d > floor, d, floor)
    root = np.where(np.abs(diagonal) * np.abs(diagonal) > floor, diagonal, np.sqrt(floor))
    low = upper / root[:-1] if n > 1 else np.zeros(0)
    s, plus = np.empty(n), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i]
        if abs(pivot) < floor:
            pivot = floor
        plus[i] = d[i] * low[i] / pivot
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p, minus = np.empty(n), np.empty(max(n - 1, 0))
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] * low[i] + p[i + 1]
        if abs(pivot) < floor:
            pivot = floor
        ratio = d[i] / pivot
        minus[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -minus[i] * z[i]
        if abs(z[i + 1]) > 1e150:  # a poor pivot must not run over
            z[: i + 2] /= 1e150
    length = np.sqrt(z @ z)
    return z / length if np.isfinite(length) and length > 0 else np.eye(n)[r]


def _without(vector: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, float]:
    """The vector without its parts along `others`, at length one, and the share that was left."""
    rest = vector - others @ (others.T @ vector)
    share = np.sqrt(rest @ rest)
    if share > 0.0:
        rest = rest / share
        rest = rest - others @ (others.T @ rest)
        rest = rest / np.sqrt(rest @ rest)
    return rest, float(share)


def _of_cluster(vector: np.ndarray, others: np.ndarray, diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """A vector at `value` orthogonal to those found already, by inverse iteration from the twisted one.

    A twisted vector that lies among the others is replaced by one that does not.
    """
    n = len(vector)
    start, share = _without(vector, others)
    if share < 1e-3:
        start, _ = max((_without(x, others) for x in np.eye(n)), key=lambda x: x[1])
    whole_b = np.diag(diagonal) + np.diag(upper, 1)
    moved = whole_b.T @ whole_b - value * (1.0 + 8 * EPS) * np.eye(n)
    for _ in range(4):
        try:
            solved = np.linalg.solve(moved, start)
        except np.linalg.LinAlgError:
            moved = moved - 64 * EPS * value * np.eye(n)
            continue
        start, _ = _without(solved / np.sqrt(solved @ solved), others)
    return start


def directions(factor: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Singular values (falling, `most` at most) with right singular vectors as columns, and the sum of all squares."""
    d = factor.shape[1]
    if len(factor) < d:  # fewer rows than dimensions
        factor = np.vstack([factor, np.zeros((d - len(factor), d))])
    diagonal, upper, right = bidiagonalise(factor)
    # Parts that rounding separates are factored by themselves: their vectors are zero elsewhere.
    size = np.abs(diagonal).max(initial=0.0) + np.abs(upper).max(initial=0.0)
    upper = np.where(np.abs(upper) <= EPS * size, 0.0, upper)
    ends = [*(np.flatnonzero(upper == 0.0) + 1).tolist(), d]
    pairs, start = [], 0
    for end in ends:
        values = singular_values(diagonal[start:end], upper[start : end - 1])
        pairs += [(v, start, end) for v in values]
        start = end
    pairs.sort(key=lambda x: -x[0])
    total = float(sum(v * v for v, _, _ in pairs))
    kept = [x for x in pairs[:most] if x[0] > d * EPS * pairs[0][0]]
    basis = np.zeros((d, len(kept)))
    for j, (value, start, end) in enumerate(kept):
        z = np.zeros(d)
        z[start:end] = twisted_vector(diagonal[start:end], upper[start : end - 1], value * value)
        first = j
        while first and kept[first - 1][0] - kept[first][0] <= CLUSTER * kept[first - 1][0]:
            first -= 1
        near = [i for i in range(first, j) if kept[i][1] == start]
        if near:
            z[start:end] = _of_cluster(z[start:end], basis[start:end, near], diagonal[start:end], upper[start : end - 1], value * value)
        basis[:, j] = z
    return np.array([v for v, _, _ in kept]), right @ basis, total


def _usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.select(vectors[id_column].cast("bigint").alias("vec_id"), vectors[vector].cast("array<double>").alias("v"))
    return rows.filter(v.isNotNull() & finite & (F.size(v) > 0))


def _blocks(batches, scale: float, shift: int):
    """(rows of the batch, x as a matrix) for blocks of vectors of one length."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("v"))
        sizes = np.diff(lists.offsets.to_numpy())
        flat = whole(lists.flatten().to_numpy(zero_copy_only=False), scale, shift)
        first = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            for at in range(0, len(rows), BLOCK):
                block = rows[at : at + BLOCK]
                yield batch, block, flat[first[block][:, None] + np.arange(dim)]


def _sums(scale: float, shift: int):
    def run(batches):
        sums: dict[int, list] = {}
        for _, block, x in _blocks(batches, scale, shift):
            n, total = sums.get(x.shape[1], (0, [0] * x.shape[1]))
            # Halves of 32 bits cannot overflow within a block.
            part = ((x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist())
            sums[x.shape[1]] = (n + len(block), [t + (h << 32) + w for t, h, w in zip(total, *part)])
        for dim, (n, total) in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"dim": [dim] * dim, "pos": list(range(dim)), "n": [n] * dim, "high": [t >> 32 for t in total], "low": [t & 0xFFFFFFFF for t in total]},
                schema=pa.schema([("dim", pa.int32()), ("pos", pa.int32()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64())]),
            )

    return run


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as longs where these hold it, else as Python's integers."""
    reach = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums), default=0)
    if reach < LONG:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


_FACTOR = "dim int, part bigint, r array<double>"


def _triangle(a: np.ndarray) -> np.ndarray:
    return np.linalg.qr(a, mode="r")


def _factor_batch(dim: int, part: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"dim": [dim], "part": [part], "r": [r.ravel()]}, schema=pa.schema([("dim", pa.int32()), ("part", pa.int64()), ("r", pa.list_(pa.float64()))])
    )


def _factors(scale: float, shift: int, held):
    def run(batches):
        kept: dict[int, np.ndarray] = {}
        for _, _, x in _blocks(batches, scale, shift):
            dim = x.shape[1]
            n, sums = held.value[dim]
            centred = (_differences(x, n, sums) / n).astype(np.float64)
            kept[dim] = _triangle(np.concatenate([kept[dim], centred]) if dim in kept else centred)
        part = TaskContext.get().partitionId()
        for dim, r in kept.items():
            yield _factor_batch(dim, part, r)

    return run


def _reduced(key, batches):
    """One triangular factor for those of a group, taken in one after the other."""
    dim, r = key[0].as_py(), None
    for batch in batches:
        for own in batch.column(batch.schema.get_field_index("r")):
            next_r = own.values.to_numpy(zero_copy_only=False).reshape(-1, dim)
            r = next_r if r is None else _triangle(np.concatenate([r, next_r]))
    yield _factor_batch(dim, key[1].as_py(), r)


def fit(
    vectors: DataFrame, most: int = 32, scale: float = 64.0, shift: int = 1_000_000, id_column: str = "vec_id", vector: str = "embedding"
) -> Fit:
    """The `most` directions of largest variance, for each length of vectors. Runs jobs."""
    rows = _usable(vectors, id_column, vector).select("v")
    spark = rows.sparkSession
    per_place = rows.mapInArrow(_sums(scale, shift), "dim int, pos int, n bigint, high bigint, low bigint")
    # A part of low is below 2^32 and there is one for each task, so that its sum stays in a long.
    summed = per_place.groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum("low").alias("low"))
    counts: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(summed.collect(), key=lambda r: (r.dim, r.pos)):
        counts.setdefault(row.dim, (row.n, []))[1].append((int(row.high) << 32) + row.low)
    held = spark.sparkContext.broadcast(counts)
    factors = cut(rows.mapInArrow(_factors(scale, shift, held), _FACTOR), "factors")
    widest = max(counts, default=1)
    fan = max(2, min(FAN_IN, FAN_BYTES // (8 * widest * widest)))
    last = factors.agg(F.max("part")).first()[0] or 0
    while last > 0:
        grouped = factors.withColumn("part", F.floor(F.col("part") / fan)).groupBy("dim", "part")
        factors = cut(grouped.applyInArrow(_grouped(), _FACTOR), "factors")
        last //= fan
    models, errors = {}, {}
    for row in factors.collect():
        r = np.array(row.r).reshape(-1, row.dim)
        n, sums = counts[row.dim]
        values, columns, total = directions(r, most)
        models[row.dim] = Model(n, sums, columns, values * values / n, total / n)
        errors[row.dim] = models[row.dim].identity_error(r)
    return Fit(scale, shift, models, errors)


def _grouped():
    from collections.abc import Iterator

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _reduced(key, batches)

    return run


RESULT = "vec_id bigint, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"


def transform(vectors: DataFrame, fitted: Fit, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """RESULT for each row that takes part; `whitened` and `explained` have a value for each direction."""
    rows = _usable(vectors, id_column, vector)
    held = rows.sparkSession.sparkContext.broadcast(fitted)

    def run(batches):
        fitted = held.value
        for batch, block, x in _blocks(batches, fitted.scale, fitted.shift):
            dim = x.shape[1]
            model = fitted.models[dim]
            away = _differences(x, model.n, model.sums)
            if away.dtype != object and float(np.abs(away).max(initial=0)) ** 2 * dim >= LONG:
                away = away.astype(object)
            deviation = np.minimum((away * away).sum(axis=1), LONG - 1).astype(np.int64)
            white = (away / model.n).astype(np.float64) @ (model.directions / np.sqrt(model.variances))
            k = white.shape[1]
            ends = pa.array(np.arange(len(block) + 1) * k, pa.int32())
            share = np.tile(model.variances / model.total, len(block)) if k else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("vec_id")).take(pa.array(block)),
                    pa.array(np.full(len(block), model.n)),
                    pa.array(deviation),
                    pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                    pa.ListArray.from_arrays(ends, pa.array(share)),
                    pa.array(np.full(len(block), fitted.identity_error[dim])),
                ],
                names=[f.split()[0] for f in RESULT.split(", ")],
            )

    return rows.mapInArrow(run, RESULT)
