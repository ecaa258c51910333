import math

import numpy as np
import pytest

from lakeloom.llm import whitening as wh
from lakeloom.llm.queries import op12_embedding_whitening


def frame(spark, vectors, ids=None):
    ids = ids or range(len(vectors))
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, component int, whitened double")


def sym(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [1e6, 1.0, 1e-3, 1e-6], [2, 2, 2, 1], [3, 3, 3], [1, 0, 0], [0, 0], [7], [1, 1 - 1e-9, 0.5],
                                    np.linspace(1, 2, 64), [4, 4 + 1e-13, 1], np.r_[np.ones(20), np.zeros(20)]])
def test_eigen_is_a_full_decomposition(values):
    v = sym(np.array(values, float))
    e, w = wh.eigen(v)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.abs(w.T @ w - np.eye(len(values))).max() < 1e-13
    assert np.abs(e - np.sort(values)[::-1]).max() <= 1e-13 * scale * len(values)
    assert np.abs(v @ w - w * e).max() <= 1e-13 * scale * len(values)


def test_polar_factor():
    v = sym(np.array([3.0, -2, 1e-6, -5, 8]))
    u = wh.polar(v)
    e, q = np.linalg.eigh(v)
    assert np.abs(u - q @ np.diag(np.sign(e)) @ q.T).max() < 1e-9
    assert np.abs(u @ u - np.eye(5)).max() < 1e-14


def brute(vectors, components=8):
    """Rows of (id, component, n, deviation, |whitened|, explained) by numpy's eigenvectors."""
    keep = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n = len(keep)
    s = [sum(col) for col in zip(*(x for _, x in keep))]
    y = np.array([[a - t / n for a, t in zip(x, s)] for _, x in keep])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    far = [sum((n * a - t) ** 2 for a, t in zip(x, s)) for _, x in keep]
    w = np.abs(y @ q / np.sqrt(e))
    total = np.trace(y.T @ y / n)
    return {(i, k + 1): (n, d, w[r, k], e[k] / total) for r, ((i, _), d) in enumerate(zip(keep, far)) for k in range(len(e))}


def compare(got, want):
    assert len(got) == len(want)
    for r in got:
        n, d, w, x = want[r.vec_id, r.component]
        assert (r.n, int(r.deviation)) == (n, d)
        assert abs(abs(r.whitened) - w) < 1e-8 and abs(r.explained - x) < 1e-10 and 0 <= r.identity_error < 1e-9


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 12)) @ np.diag(np.linspace(1, 3, 12))
    vectors = [[float(c) for c in v] for v in base] + [None, [1.0] * 11 + [None], [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1.0, 2.0], [],
                                                     [float(c) for c in base[0]]]
    good = [(i, v) for i, v in enumerate(vectors) if v is None or len(v) == 12]
    compare(wh.whiten(frame(spark, vectors)).collect(), brute(good))


def test_whitened_covariance_is_the_identity(spark):
    rng = np.random.default_rng(4)
    out = wh.whiten(frame(spark, [[float(c) for c in v] for v in rng.normal(size=(200, 5))]), components=3).toPandas()
    y = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(y.T, bias=True) - np.eye(3)).max() < 1e-10 and np.abs(y.mean(axis=0)).max() < 1e-10


def test_large_entries_stay_exact(spark):
    vectors = [[1e9, 2.0], [-1e9, 5.0], [3.0, -7.0], [3e38, 1.0]]
    out = wh.whiten(frame(spark, vectors), components=2).collect()
    x = [[max(-wh.FAR, min(wh.FAR, math.floor(1024 * float(np.float32(c))))) + 100_000 for c in v] for v in vectors]
    s = [sum(c) for c in zip(*x)]
    far = [sum((4 * a - t) ** 2 for a, t in zip(v, s)) for v in x]
    assert {r.vec_id: int(r.deviation) for r in out} == dict(enumerate(far))


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[], []]])
def test_no_variance_no_rows(spark, vectors):
    out = wh.whiten(frame(spark, vectors))
    assert out.collect() == [] and out.columns[:3] == ["vec_id", "component", "n"]


def test_rank_null_ids_and_repeats(spark):
    vectors = [[1.0, 2.0, 0.0], [2.0, 4.0, 0.0], [3.0, 6.0, 0.0], [3.0, 6.0, 0.0]]
    out = wh.whiten(frame(spark, vectors, [None, 1, 1, 2])).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in out) == [("1", 1, 4), ("1", 1, 4), ("2", 1, 4), ("None", 1, 4)]


def test_query_against_numpy(spark):
    small = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    got = op12_embedding_whitening(spark, small)
    assert dict(got.dtypes)["deviation"] == "bigint"
    compare(got.collect(), brute([(r.vec_id, r.embedding) for r in rows]))
