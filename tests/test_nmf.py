"""ML-03..06: distributed NMF against a single-node numpy solver and invariants."""

import numpy as np
import pandas as pd
import pytest

from topicloom.operators import nmf


def _planted(seed=0, n=240, k=3, v=30):
    rng = np.random.default_rng(seed)
    H = np.zeros((k, v))
    for j in range(k):
        H[j, j * (v // k):(j + 1) * (v // k)] = rng.uniform(0.5, 1.5, v // k)
    W = rng.gamma(0.3, 1.0, (n, k))
    X = W @ H
    X[X < 0.05] = 0.0
    norms = np.linalg.norm(X, axis=1, keepdims=True)
    X = np.where(norms > 0, X / np.where(norms > 0, norms, 1), 0)
    return X, H


def _to_spark(spark, X):
    rows = []
    for i, r in enumerate(X):
        idx = np.nonzero(r)[0]
        rows.append((i, [int(x) for x in idx], [float(x) for x in r[idx]]))
    return spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "indices", "values"])).repartition(5).persist()


def test_solve_rows_matches_bruteforce():
    rng = np.random.default_rng(1)
    Hm = rng.uniform(0, 1, (3, 8))
    X = rng.uniform(-0.2, 1, (20, 8))
    W = nmf.solve_rows(X @ Hm.T, Hm @ Hm.T)
    from itertools import combinations

    for i in range(len(X)):
        best = np.inf
        for r in range(0, 4):
            for S in combinations(range(3), r):
                w = np.zeros(3)
                if S:
                    sol, *_ = np.linalg.lstsq(Hm[list(S)].T, X[i], rcond=None)
                    if (sol < 0).any():
                        continue
                    w[list(S)] = sol
                best = min(best, np.sum((X[i] - w @ Hm) ** 2))
        assert np.sum((X[i] - W[i] @ Hm) ** 2) <= best + 1e-8


def test_argmax_ties_and_zero_rows():
    W = np.array([[0.0, 0.0, 0.0], [1.0, 2.0, 2.0]])
    assert list(W.argmax(axis=1)) == [0, 1]
    assert list(W.max(axis=1)) == [0.0, 2.0]


@pytest.fixture(scope="module")
def planted(spark):
    X, H = _planted()
    return X, H, _to_spark(spark, X)


def test_fit_matches_single_node(planted):
    X, _, Xs = planted
    k, V = 3, X.shape[1]
    res = nmf.fit(Xs, k, V, max_iter=200, tol=1e-6)
    assert (res.H >= 0).all()
    errs = np.array(res.errors[:-1])
    assert (np.diff(errs) <= 1e-9 * errs[0]).all(), "error must not increase"
    # single-node reference: same init, same alternating updates on the dense matrix
    H = nmf.nndsvda_init(Xs, k, V, seed=42)
    prev = None
    for _ in range(200):
        W = nmf.solve_rows(X @ H.T, H @ H.T)
        err = np.linalg.norm(X - W @ H)
        H = nmf.solve_h(W.T @ W, W.T @ X, H)
        if prev is not None and prev - err <= 1e-6 * prev:
            break
        prev = err
    W = nmf.solve_rows(X @ H.T, H @ H.T)
    ref = np.linalg.norm(X - W @ H)
    assert abs(res.reconstruction_error - ref) <= 0.01 * ref
    assert res.reconstruction_error <= np.linalg.norm(X)


def test_recovers_planted_topics(planted):
    X, Htrue, Xs = planted
    res = nmf.fit(Xs, 3, X.shape[1], max_iter=200, tol=1e-6)
    found = [set(np.argsort(h)[-10:]) for h in res.H]
    truth = [set(np.nonzero(h)[0]) for h in Htrue]
    for t in truth:
        assert max(len(t & f) for f in found) >= 9


def test_transform_assigns_all_rows(spark, planted):
    X, _, Xs = planted
    res = nmf.fit(Xs, 3, X.shape[1], max_iter=50)
    a = nmf.transform(Xs, res.H).toPandas()
    assert len(a) == len(X)
    assert a["topic_score"].min() >= 0
    assert set(a["topic_id"]) <= {0, 1, 2}


def test_one_step_multiplicative_update(spark, planted):
    X, _, Xs = planted
    k, V = 3, X.shape[1]
    WtW, WtX = nmf.fixed_w_pass(Xs, k, V, nmf.cyclic_start_w)
    W0 = nmf.cyclic_start_w(np.arange(len(X)), k)
    np.testing.assert_allclose(WtW, W0.T @ W0, rtol=1e-10)
    np.testing.assert_allclose(WtX, W0.T @ X, rtol=1e-10, atol=1e-12)
