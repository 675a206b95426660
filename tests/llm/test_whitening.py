import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearloom.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, k=8):
    """n, exact deviations, covariance's eigenvalues and -vectors, whitened rows (components as rows)."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    a = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    e, w = np.linalg.eigh(a.T @ a / n)
    e, w = e[::-1], w[:, ::-1]
    return n, deviation, e, w, (a @ w[:, :k]) / np.sqrt(np.maximum(e[:k], 1e-300))


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def check(out, ids, vectors, k):
    n, deviation, e, w, white = brute(vectors, k)
    got = {(r.vec_id, r.component): r for r in out}
    assert len(got) == len(out) == len(ids) * k
    for c in range(k):
        column = np.array([got[i, c + 1].whitened for i in ids])
        sign = np.sign(column @ white[:, c])
        assert np.allclose(column, sign * white[:, c], atol=1e-6 * np.abs(white[:, c]).max(), rtol=1e-6)
    for i, d in zip(ids, deviation):
        r = got[i, 1]
        assert (r.n, r.deviation) == (n, d) and abs(r.explained / (e[0] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
    assert len({r.identity_error for r in out}) == 1


@pytest.mark.parametrize("n,d", [(300, 16), (40, 12), (9, 24), (60, 3)])
def test_components_equal_eigenvectors(spark, n, d):
    rng = np.random.default_rng(n)
    vectors = (rng.normal(size=(n, d)) @ np.diag(2.0 ** -np.arange(d)) * 50 + rng.normal(size=d)).astype(np.float32).tolist()
    out = W.whiten(table(spark, list(enumerate(vectors))).repartition(4)).collect()
    check(out, range(n), vectors, min(8, d, n - 1))


def test_ill_conditioned_rows(spark):
    """Columns that nearly repeat: the covariance's condition number is far beyond 1/eps^(1/2)."""
    rng = np.random.default_rng(3)
    base = rng.integers(-2**20, 2**20, 500)
    vectors = np.column_stack([base / 1024, (base + rng.integers(-1, 2, 500)) / 1024, rng.integers(-3, 4, 500) / 1024]).tolist()
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    rows = W.fixed_point(df, "vec_id", "embedding")
    x = np.array([r.x for r in rows.orderBy("vec_id").collect()])
    assert (x == np.floor(np.array(vectors) * 1024) + 100_000).all()
    centre = W.Centre(500, x.sum(0).tolist())
    r, passes = W.triangular_factor(rows, centre, np.ones(3, bool))
    q = W.solve_right(centre(x), r)
    assert passes >= 2 and np.abs(q.T @ q - np.eye(3)).max() < 1e-9
    s = np.linalg.svd(centre(x), compute_uv=False)
    assert np.allclose(np.linalg.svd(r, compute_uv=False), s, rtol=1e-9)


def test_blocks_and_salts_add_up(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_NUMBERS", 30)
    monkeypatch.setattr(W, "SALTS", 2)
    rng = np.random.default_rng(8)
    x = rng.integers(-50, 50, (200, 13))
    rows = spark.createDataFrame([(v,) for v in x.tolist()], "x array<long>").repartition(7)
    assert np.array_equal(W.gram(rows, lambda v: v.astype(float), 13), (x.T @ x).astype(float))


def test_triangular_solve():
    rng = np.random.default_rng(1)
    r = np.triu(rng.normal(size=(70, 70))) + 9 * np.eye(70)
    y = rng.normal(size=(5, 70))
    assert np.allclose(W.solve_right(y @ r, r), y)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(30, 4)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(good)] + [(None, good[0]), (3, good[3]), (3, good[3])]
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0, 3.0]), (53, [float("nan"), 1.0, 1.0, 1.0]), (54, [float("inf"), 1.0, 1.0, 1.0]),
           (55, [1.0, 2.0]), (56, [3e38, 1.0, 1.0, 1.0])]
    df = table(spark, rows + odd).withColumn("x", F.lit(1)).withColumn("n", F.lit("n")).withColumn("component", F.lit(2))
    out = W.whiten(df).collect()
    n, deviation, *_ = brute([v for _, v in rows], 4)
    assert sorted(((r.vec_id, r.deviation) for r in out if r.component == 1), key=repr) == sorted(zip([i for i, _ in rows], deviation), key=repr)
    assert len(out) == len(rows) * 4 and {r.n for r in out} == {n}


def test_no_variance(spark):
    same = [0.5, -1.0, 2.0]
    assert W.whiten(table(spark, [(1, same)])).count() == 0
    assert W.whiten(table(spark, [(1, same), (2, same)])).count() == 0
    empty = W.whiten(table(spark, []))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    vectors = [[1.0, 5.0, float(k), 2.0 * k] for k in range(10)]  # two constant dimensions, two that go together
    out = W.whiten(table(spark, list(enumerate(vectors)))).collect()
    assert {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-12 and out[0].identity_error < 1e-9


def test_deviations_beyond_64_bits():
    x = np.array([[0, 1 << 39], [1 << 39, 5], [7, 7]])
    centre = W.Centre(3, x.sum(0).tolist())
    want = [sum((3 * a - s) ** 2 for a, s in zip(v, x.sum(0).tolist())) for v in x.tolist()]
    assert centre.deviations(x) == [w if w < 1 << 63 else None for w in want]
    small = W.Centre(3, (x >> 20).sum(0).tolist())
    assert small.deviations(x >> 20) == [sum((3 * a - s) ** 2 for a, s in zip(v, (x >> 20).sum(0).tolist())) for v in (x >> 20).tolist()]


def test_query(spark):
    from yearloom.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(sf + "/embeddings.parquet").collect()]
    whole = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    check(queries.op12_whitening(spark, sf).collect(), [i for i, _ in whole], [v for _, v in whole], 8)
