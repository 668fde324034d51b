import math

import numpy as np
import pytest

from keyflow.llm import whitening
from keyflow.llm.queries import op11_qdwh_whitening

SF = "/root/testdata/sf0.01"


def matrices():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    for d in (1, 2, 7, 64):
        a = rng.standard_normal((5 * d, d)) * np.geomspace(1, 1e-3, d)
        yield a.T @ a
    yield q @ np.diag([5.0] * 5 + [1.0] * 15) @ q.T
    yield q @ np.diag([5.0] + [0.0] * 19) @ q.T
    yield q @ np.diag(np.geomspace(1e12, 1, 20)) @ q.T
    yield np.eye(6)
    yield np.zeros((3, 3))


@pytest.mark.parametrize("cov", list(matrices()))
def test_components_are_eigenvectors(cov):
    size = max(np.abs(cov).max(), 1e-300)
    for top in (None, 4):
        e, v = whitening.components(cov, top)
        want = np.sort(np.linalg.eigvalsh(cov))[::-1][:len(e)]
        assert len(e) == min(top or len(cov), len(cov))
        assert np.abs(e - want).max() <= 1e-13 * size * len(cov)
        assert np.abs(cov @ v - v * e).max() <= 1e-13 * size * len(cov)
        assert np.abs(v.T @ v - np.eye(len(e))).max() <= 1e-13


def test_polar_factor_of_nearly_singular_matrix():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    e = np.array([1, -1, 1e-9, -1e-9, 1e-13, -1e-13, 0.3, -0.2, 5, -7, 1e-4, 2])
    u = whitening.polar_factor(q @ np.diag(e) @ q.T)
    assert np.abs(u @ u - np.eye(12)).max() < 1e-12
    assert np.abs(u - q @ np.diag(np.sign(e)) @ q.T).max() < 1e-2


def brute(vectors):
    """{vec_id: (deviation, whitened by component)}, e and trace, by numpy's own eigensolver."""
    x = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in vectors]
    fit = np.array(sorted({tuple(v) for _, v in x}), dtype=np.int64)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    cov = c.T @ c / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:4], v[:, ::-1][:, :4]
    rows = [(i, sum((n * int(a) - int(b)) ** 2 for a, b in zip(y, s)),
             (np.array(y) - s / n) @ v / np.sqrt(e)) for i, y in x]
    return rows, n, e / np.trace(cov)


def check(got, vectors):
    rows, n, share = brute(vectors)
    assert len(got) == 4 * len(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    signs = {}
    for i, deviation, z in rows:
        for k in range(4):
            r = by[i][k + 1]
            assert r.n == n and r.deviation == deviation
            assert abs(r.explained - share[k]) <= 1e-9 * share[k]
            assert r.identity_error <= 1e-9
            if abs(z[k]) > 1e-6:
                sign = signs.setdefault(k, math.copysign(1, z[k] * r.whitened))
                assert abs(r.whitened - sign * z[k]) <= 1e-8 * max(1, abs(z[k]))


def test_query_matches_numpy(llm):
    vectors = [(r.vec_id, r.embedding)
               for r in llm.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(op11_qdwh_whitening(llm, SF).collect(), vectors)


def test_odd_rows(llm):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    good += [(100 + i, good[0][1]) for i in range(500)]  # repeated rows: one row of the fit list
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [None] * 5),
           (904, [float("nan")] * 5), (905, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (906, [1.0, 2.0])]
    rows = [(i, v, "z", 1) for i, v in good + bad]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>, x string, n int")
    check(whitening.whiten(df).collect(), good)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.filter("vec_id >= 900 and vec_id < 906")).count() == 0


def test_no_variance_and_large_entries(llm):
    df = llm.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0]), (None, [1.0, 2.0])],
                             "vec_id string, embedding array<float>")
    got = whitening.whiten(df).collect()
    assert len(got) == 6
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {
        (1, 0, None, 0.0, 0.0)}
    far = llm.createDataFrame([(1, [1e300]), (2, [0.0]), (3, [1.0])], "vec_id int, embedding array<double>")
    got = whitening.whiten(far).collect()
    assert len(got) == 3 and all(r.deviation is None for r in got)
