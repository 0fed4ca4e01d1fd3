import math

import numpy as np
import pytest

from chunkloom.llm import whitening
from tests.llm.samples import with_clashes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def random_bidiagonal(rng, n, low):
    return rng.normal(size=n) * np.logspace(0, low, n), rng.normal(size=n - 1) * np.logspace(0, low, n)[: n - 1]


@pytest.mark.parametrize("seed", range(12))
def test_singular_values(seed):
    rng = np.random.default_rng(seed)
    diagonal, upper = random_bidiagonal(rng, int(rng.integers(2, 50)), -int(rng.integers(0, 6)))
    want = np.linalg.svd(np.diag(diagonal) + np.diag(upper, 1), compute_uv=False)
    got = whitening.singular_values(diagonal, upper)
    assert np.abs(got - want).max() <= 1e-13 * want[0]


def test_small_singular_values_keep_their_digits():
    # B and its mirrored transpose have the same values; a solver with absolute errors only would not agree.
    diagonal, upper = np.logspace(0, -60, 20), np.logspace(0, -57, 19) * 1e-2
    up, down = whitening.singular_values(diagonal, upper), whitening.singular_values(diagonal[::-1], upper[::-1])
    assert up[-1] < 1e-55 and np.abs(up / down - 1).max() < 1e-12
    assert np.prod(up / diagonal) == pytest.approx(1.0, rel=1e-10)


def test_zeros():
    assert whitening.singular_values(np.zeros(4), np.zeros(3)).tolist() == [0.0] * 4
    for diagonal in ([1.0, 0.0, 2.0], [0.0, 1.0, 2.0], [1.0, 2.0, 0.0], [0.0, 0.0, 3.0]):
        upper = np.array([0.5, 0.25])
        want = np.linalg.svd(np.diag(diagonal) + np.diag(upper, 1), compute_uv=False)
        assert whitening.singular_values(np.array(diagonal), upper) == pytest.approx(want, abs=1e-14)


def shapes():
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    yield rng.normal(size=(200, 24))
    yield rng.normal(size=(200, 24)) * np.logspace(0, -7, 24)
    yield np.eye(24) * 3
    yield turn * np.array([5.0] * 4 + [4.0] * 4 + [1.0] * 16) @ turn.T
    yield rng.normal(size=(200, 5)) @ rng.normal(size=(5, 24))
    yield rng.normal(size=(200, 24)) * np.array([0.0] * 9 + [1.0] * 15)
    yield np.round(rng.normal(size=(500, 24)) * 3)
    yield np.zeros((5, 24))


@pytest.mark.parametrize("rows", list(shapes()))
def test_directions(rows):
    values, columns, total = whitening.directions(np.linalg.qr(rows, mode="r"), 24)
    want = np.linalg.svd(rows, compute_uv=False)
    rank = int((want > 24 * whitening.EPS * want[0]).sum()) if want[0] else 0
    assert len(values) == rank and total == pytest.approx(float((want**2).sum()))
    if rank:
        assert values == pytest.approx(want[:rank], abs=1e-13 * want[0])
        assert np.abs(columns.T @ columns - np.eye(rank)).max() < 1e-10
        assert np.abs(rows.T @ (rows @ columns) - columns * values**2).max() < 1e-12 * want[0] ** 2


def table(spark, vectors, **extra):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA)


def brute(vectors, most=32):
    """(id, n, deviation, whitened up to sign, explained) by a dense solver of the covariance."""
    usable = [(i, v) for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for dim in {len(v) for _, v in usable}:
        own = [(i, [math.floor(64 * float(np.float32(x))) + 1_000_000 for x in v]) for i, v in usable if len(v) == dim]
        n, sums = len(own), [sum(col) for col in zip(*(x for _, x in own))]
        away = np.array([[(n * x - s) / n for x, s in zip(row, sums)] for _, row in own])
        e, v = np.linalg.eigh(away.T @ away / n)
        kept = [k for k in np.argsort(-e) if e[k] > 1e-12 * max(e.max(), 1e-300)][:most]
        for (i, row), c in zip(own, away):
            deviation = sum((n * x - s) ** 2 for x, s in zip(row, sums))
            out.append((i, n, deviation, [c @ v[:, k] / math.sqrt(e[k]) for k in kept], [e[k] / e.sum() for k in kept]))
    return out


def agree(rows, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    rows, want = sorted(((r.vec_id, r.n, r.deviation, r.whitened, r.explained) for r in rows), key=key), sorted(want, key=key)
    assert [r[:3] for r in rows] == [r[:3] for r in want]
    signs: dict = {}
    for got, ref in zip(rows, want):
        assert len(got[3]) == len(ref[3])
        assert got[4] == pytest.approx(ref[4], rel=1e-9)
        for k, (x, y) in enumerate(zip(got[3], ref[3])):
            if abs(y) > 1e-6:
                sign = signs.setdefault((len(got[3]), k), math.copysign(1, x * y))
                assert x == pytest.approx(sign * y, abs=1e-6)


def test_against_a_dense_solver(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(7)
    vectors = [(i, (rng.normal(size=6) * [3, 2, 1, 0.5, 0.3, 0.2]).tolist()) for i in range(300)]
    vectors += [(5, vectors[5][1]), (None, vectors[6][1]), (400, None), (401, []), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [float("nan")] * 6), (404, [float("inf")] + [0.0] * 5)]
    vectors += [(500 + i, rng.normal(size=3).tolist()) for i in range(20)]
    frame = with_clashes(table(spark, vectors)).repartition(7)
    agree(whitening.transform(frame, whitening.fit(frame)).collect(), brute(vectors))
    errors = {r.identity_error for r in whitening.transform(frame, whitening.fit(frame, most=2)).collect()}
    assert len(errors) == 2 and max(errors) < 1e-9


def test_whitened_rows_have_the_identity_as_covariance(spark):
    from chunkloom.llm.queries import op11_whitening
    from tests.llm.test_queries import FOLDER

    rows = op11_whitening(spark, FOLDER).collect()
    ids = sorted({r.vec_id for r in rows})
    white = np.zeros((len(ids), 32))
    at = {i: k for k, i in enumerate(ids)}
    for r in rows:
        white[at[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(white.T @ white / len(ids) - np.eye(32)).max() < 1e-9
    assert np.abs(white.mean(axis=0)).max() < 1e-9 and {r.n for r in rows} == {len(ids)}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = {i: (n, d, e) for i, n, d, _, e in brute(vectors)}
    for r in rows:
        n, deviation, explained = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation) and r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)


def test_single_and_equal_rows_have_no_direction(spark):
    for vectors in ([(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(9)]):
        frame = table(spark, vectors)
        got = whitening.transform(frame, whitening.fit(frame)).collect()
        assert len(got) == len(vectors)
        assert {(r.n, r.deviation, tuple(r.whitened), r.identity_error) for r in got} == {(len(vectors), 0, (), 0.0)}


def test_values_beyond_a_long(spark):
    vectors = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])]
    frame = table(spark, vectors)
    got = {r.vec_id: r for r in whitening.transform(frame, whitening.fit(frame)).collect()}
    assert got[1].deviation == got[2].deviation == whitening.LONG - 1
    assert all(math.isfinite(x) for r in got.values() for x in r.whitened)


def test_empty_table(spark):
    frame = table(spark, [])
    assert whitening.transform(frame, whitening.fit(frame)).collect() == []
