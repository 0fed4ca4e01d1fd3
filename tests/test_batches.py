"""Arrow kernels against plain Python."""

import math

import numpy as np
import pyarrow as pa
import pytest

from chunkloom.functions import batches


def made(n, lengths, groups, kind, seed=1):
    """Vectors of several lengths in random order, some unusable, and their video ids, some null."""
    rng = np.random.default_rng(seed)
    ids, vectors = [], []
    for i in range(n):
        vector = [float(x) for x in rng.normal(size=lengths[i % len(lengths)]).astype(np.float32)]
        if i % 17 == 3:
            vector[-1] = [float("nan"), float("inf"), None][i % 3]
        ids.append(None if i % 7 == 0 else int(rng.integers(groups)))
        vectors.append(None if i % 13 == 0 else [] if i % 13 == 1 else vector)
    return ids, vectors, pa.array(vectors, pa.list_(kind))


def usable(v):
    return bool(v) and all(e is not None and math.isfinite(e) for e in v)


def unit(v):
    return np.array(v) / max(np.linalg.norm(v), 1e-6)


CASES = [
    (400, [5], 9, pa.float32()),
    (400, [5, 3, 8], 9, pa.float64()),
    (300, [1200], 40, pa.float32()),
    (90, [150_000 // 64, 2], 3, pa.float64()),
]


@pytest.mark.parametrize("n, lengths, groups, kind", CASES)
@pytest.mark.parametrize("ordered", [False, True])
def test_partial_sums(n, lengths, groups, kind, ordered):
    ids, vectors, column = made(n, lengths, groups, kind)
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), column], names=["video_id", "vector"])
    if ordered:
        batch = batch.sort_by("video_id")
    counts, sums = {}, {}
    for piece in batches.partial_sums([batch.slice(0, 50), batch.slice(50)]):
        for row in piece.to_pylist():
            key = (row["video_id"], row["size"])
            counts[key] = counts.get(key, 0) + row["n"]
            if row["total"] is not None:
                sums[key] = sums.get(key, 0) + np.array(row["total"])
    expected_counts, expected_sums = {}, {}
    for video, vector in zip(ids, vectors):
        key = (video, len(vector) if usable(vector) else 0)
        expected_counts[key] = expected_counts.get(key, 0) + 1
        if usable(vector):
            expected_sums[key] = expected_sums.get(key, 0) + unit(vector)
    assert counts == expected_counts
    assert sums.keys() == expected_sums.keys()
    for key, total in expected_sums.items():
        assert sums[key] == pytest.approx(total)


@pytest.mark.parametrize("n, lengths, groups, kind", CASES)
def test_cosine_to(n, lengths, groups, kind):
    _, left, column = made(n, lengths, groups, kind)
    _, right, other = made(n, lengths[::-1], groups, pa.float64(), seed=2)
    right = [r if usable(r) else None for r in right]
    got = batches.cosine_to.func(column.slice(1), pa.array(right, pa.list_(pa.float64())).slice(1)).to_pylist()
    for value, a, b in zip(got, left[1:], right[1:], strict=True):
        if usable(a) and b is not None and len(a) == len(b):
            assert value == pytest.approx(float(unit(a) @ np.array(b)), abs=1e-12)
        else:
            assert value is None
