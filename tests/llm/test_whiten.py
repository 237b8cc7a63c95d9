"""Whitening against whole numbers in plain Python and NumPy's covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from orderlens.llm import queries, whiten

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, n int, component string"


def whole(vector):
    return [math.floor(Fraction(float(np.float32(c))) * 1024) + 100_000 for c in vector]


def check(rows, vectors, count=8):
    """rows: vec_id, component, n, deviation, whitened, explained, identity_error; vectors: (id, entries)."""
    n, dim = len(vectors), len(vectors[0][1])
    x = {i: whole(v) for i, v in vectors}
    sums = [sum(v[k] for v in x.values()) for k in range(dim)]
    centred = np.array([[float(Fraction(v[k] * n - sums[k], n)) for k in range(dim)] for v in x.values()])
    cov = centred.T @ centred / n
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    assert sorted((r[0], r[1]) for r in rows) == sorted((i, k) for i in x for k in range(1, min(count, dim) + 1))
    assert {r[2] for r in rows} == {n}
    for r in rows:
        assert r[3] == sum((n * c - s) ** 2 for c, s in zip(x[r[0]], sums))
        assert r[5] == pytest.approx(values[r[1] - 1] / values.sum(), rel=1e-9)
    order = {i: k for k, i in enumerate(x)}
    for k in range(1, min(count, dim) + 1):
        white = np.empty(n)
        for r in rows:
            if r[1] == k:
                white[order[r[0]]] = r[4]
        # The projection is cov's eigenvector: cov applied to the back-projection scales it by the eigenvalue.
        axis = centred.T @ white / n / math.sqrt(values[k - 1])
        assert np.linalg.norm(axis) == pytest.approx(1, abs=1e-9)
        assert cov @ axis == pytest.approx(values[k - 1] * axis, abs=1e-6 * values[0])
        assert centred @ axis / math.sqrt(values[k - 1]) == pytest.approx(white, abs=1e-7)
    assert len({r[6] for r in rows}) == 1 and 0 <= rows[0][6] < 1e-9


def test_query(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check([tuple(r) for r in queries.op12_whitening(spark, FOLDER).collect()], vectors)


def test_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.normal(0, 1 + i % 3, 5).astype(np.float32)]) for i in range(150)]
    good += [(200, [0.0] * 5), (201, [-97.65625, -100.0, 3.0, 300.0, -150.0])]
    nan, inf = float("nan"), float("inf")
    bad = [(300, None), (301, []), (302, [1.0, None, 1.0, 1.0, 1.0]), (303, [nan, 1.0, 1.0, 1.0, 1.0]),
           (304, [1.0, inf, 1.0, 1.0, 1.0]), (305, [1.0, -inf, 1.0, 1.0, 1.0]), (306, [1.0, 2.0]), (307, [1.0] * 6)]
    df = spark.createDataFrame([(*r, None, 7, "clash") for r in good + bad], SCHEMA).repartition(3)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    check([tuple(r) for r in queries.op12_whitening(spark, str(tmp_path)).collect()], good)


def test_degenerate(spark):
    frame = lambda rows: spark.createDataFrame([(*r, 0, 0, "") for r in rows], SCHEMA)
    assert whiten.whiten(frame([(1, None)])).count() == 0
    assert whiten.whiten(frame([]).limit(0)).count() == 0
    alone = whiten.whiten(frame([(None, [1.0, 2.0])])).collect()
    assert [(r._id, r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in alone] == [
        (None, 1, 1, 0, None, None, None), (None, 2, 1, 0, None, None, None)]
    # The second dimension never changes; repeated ids are rows of their own.
    flat = whiten.whiten(frame([(1, [1.0, 2.0]), (1, [3.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert len(flat) == 6 and all((r.whitened is None) == (r.component == 2) for r in flat)
    assert flat[0].identity_error < 1e-9


def test_far_outlier(spark):
    """A number beyond a long is held at its end; a deviation of more than 38 digits is null."""
    df = spark.createDataFrame([(1, [1e30, 0.0], 0, 0, ""), (2, [0.0, 1.0], 0, 0, ""), (3, [1.0, 0.0], 0, 0, "")], SCHEMA)
    rows = {(r._id, r.component): r for r in whiten.whiten(df).collect()}
    y = [3 * 2**63 - 3 - (2**63 - 1 + 100_000 + 101_024), 0]
    assert len(rows) == 6 and y[0] ** 2 > 10**38 and rows[1, 1].deviation is None
    assert rows[2, 1].explained == pytest.approx(1) and rows[1, 1].whitened is not None


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    for x in (rng.integers(99_000, 101_000, (1000, 7)), rng.integers(-2**62, 2**62, (130, 3)),
              np.array([[2**63 - 1, -(2**63), 0]] * 3 + [[-(2**63), 5, 0]])):
        total, cross = whiten.scatter(x.astype(np.int64))
        plain = x.astype(np.int64).astype(object)
        assert (total == plain.sum(axis=0)).all() and (cross == plain.T @ plain).all()


def test_limbs_and_squares():
    for v in (0, 1, -1, 2**126 * 2**50, -(2**175) + 3):
        assert sum(p << (32 * k) for k, p in enumerate(whiten.limbs(v))) == v
        assert all(-(2**63) <= p < 2**63 for p in whiten.limbs(v))
    rng = np.random.default_rng(2)
    for most, dim in ((2**20, 64), (2**40, 100), (2**57 - 1, 70), (2**61, 4)):
        y = rng.integers(-most, most, (20, dim))
        assert whiten.squares(y) == [int(s) for s in (y.astype(object) ** 2).sum(axis=1)]


def test_entries_beyond_a_long():
    import pyarrow as pa
    x = whiten.numbers(pa.array([[1e300, -1e300, 1e18], [2.0, -97.66, 0.0]]), 2 + 1)
    assert x.tolist() == [[2**63 - 1, -(2**63) + 100_000, 2**63 - 1], [102_048, -4, 100_000]]
