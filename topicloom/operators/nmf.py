"""Distributed non-negative matrix factorisation (ML-03..06, WIN-02/03).

Objective: ``min ||X - W H||_F^2`` with ``W, H >= 0``; X is the L2-normalised
TF-IDF matrix (documents x terms), k topics.

Plan (alternating non-negative least squares, one Spark job per iteration):

* X is a persisted DataFrame ``(doc_id, indices, values)``; H (k x V, at most
  k * max_features doubles) is broadcast.
* Each pass solves every row ``w_i = argmin_{w>=0} ||x_i - w H||`` inside
  ``mapInPandas`` (vectorised coordinate descent over a whole Arrow batch, warm
  started from the clipped least-squares solution) and emits only the partial
  sums ``W^T W`` (k x k), ``W^T X`` (k x V) and the error terms, one array a topic:
  some 3k rows a partition.  They are added up as a tree, ``FAN_IN`` partitions at a
  time, and the driver receives a k x V matrix -- bounded by the model size, not by the
  data.
* The driver updates H by the same coordinate rule on those sums.
* W is never stored, so lineage does not grow across iterations and a lost
  executor only costs a recomputation of one pass over the cached X.
* Init is NNDSVDa (Boutsidis & Gallopoulos 2008): the top-k singular vectors
  come from randomized subspace iteration built on the same pass machinery
  (``X^T (X Q)`` partial sums); the sign split needs only the norms of the
  positive and negative parts of ``X v / sigma`` (one more pass).
* Stop when the relative drop of the error is below ``tol`` or at ``max_iter``; the result
  says which (``converged``), and how many rows the inner solver left unfinished in the
  last pass (``unsolved_rows``).

Assignment (WIN-03): topic = argmax of the row of W (lowest index on ties),
score = the max; an all-zero row gives topic 0 with score 0.0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTIAL_SCHEMA = "part long, m int, i int, v array<double>"
#: Partitions whose partial sums one task adds up.
FAN_IN = 64
# partial kinds
M_WTW, M_WTX, M_SCALAR, M_GRAM, M_UNORM = 0, 1, 2, 3, 4
S_XX, S_CROSS, S_SUMX, S_ROWS, S_UNSOLVED = 0, 1, 2, 3, 4

EPS = 1e-12


# ----------------------------------------------------------------- per-batch numpy kernels


def _flatten(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Batch of sparse rows -> (row index, column, value) arrays of all non-zeros."""
    n = len(pdf)
    lens = np.fromiter((len(a) for a in pdf["indices"]), dtype=np.int64, count=n)
    if lens.sum() == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), n
    rows = np.repeat(np.arange(n), lens)
    cols = np.concatenate([np.asarray(a, dtype=np.int64) for a in pdf["indices"] if len(a)])
    vals = np.concatenate([np.asarray(a, dtype=np.float64) for a in pdf["values"] if len(a)])
    return rows, cols, vals, n


def _x_times(rows, cols, vals, n: int, M: np.ndarray) -> np.ndarray:
    """X_batch @ M for M of shape (V, p)."""
    out = np.zeros((n, M.shape[1]))
    if len(vals):
        for c in range(M.shape[1]):
            out[:, c] = np.bincount(rows, weights=vals * M[cols, c], minlength=n)
    return out


def _xt_times(rows, cols, vals, n_cols: int, Y: np.ndarray) -> np.ndarray:
    """X_batch^T @ Y for Y of shape (n, p) -> (V, p)."""
    out = np.zeros((n_cols, Y.shape[1]))
    if len(vals):
        for c in range(Y.shape[1]):
            out[:, c] = np.bincount(cols, weights=vals * Y[rows, c], minlength=n_cols)
    return out


def solve_rows(B: np.ndarray, G: np.ndarray, max_sweeps: int = 200, tol: float = 1e-10) -> np.ndarray:
    """Non-negative least squares for many right-hand sides at once.

    Minimises ``||x - w H||^2`` for each row given ``B = X H^T`` and ``G = H H^T``
    by cyclic coordinate descent, warm started from the clipped unconstrained
    solution."""
    return _solve_rows(B, G, max_sweeps, tol)[0]


def _solve_rows(B: np.ndarray, G: np.ndarray, max_sweeps: int = 200, tol: float = 1e-10) -> tuple[np.ndarray, int]:
    """As ``solve_rows``, and how many rows still moved when the sweeps ran out."""
    k = G.shape[0]
    W = np.maximum(B @ np.linalg.pinv(G), 0.0)
    diag = np.diag(G).copy()
    unsolved = 0
    for _ in range(max_sweeps):
        change = np.zeros(len(W))
        for j in range(k):
            if diag[j] <= EPS:
                W[:, j] = 0.0
                continue
            new = np.maximum(W[:, j] + (B[:, j] - W @ G[:, j]) / diag[j], 0.0)
            np.maximum(change, np.abs(new - W[:, j]), out=change)
            W[:, j] = new
        unsolved = int((change > tol * max(1.0, float(np.abs(W).max(initial=0.0)))).sum())
        if not unsolved:
            break
    return W, unsolved


def solve_h(A: np.ndarray, B: np.ndarray, H: np.ndarray, max_sweeps: int = 200, tol: float = 1e-10) -> np.ndarray:
    """H-step on the driver: ``min_{H>=0} ||X - W H||^2`` from ``A = W^T W`` (k x k)
    and ``B = W^T X`` (k x V), warm started from the current H."""
    H = H.copy()
    k = A.shape[0]
    for _ in range(max_sweeps):
        change = 0.0
        for j in range(k):
            if A[j, j] <= EPS:
                continue
            new = np.maximum(H[j] + (B[j] - A[j] @ H) / A[j, j], 0.0)
            change = max(change, float(np.abs(new - H[j]).max(initial=0.0)))
            H[j] = new
        if change <= tol * max(1.0, float(np.abs(H).max(initial=0.0))):
            break
    return H


# ----------------------------------------------------------------- Spark passes


def _rows_of(*matrices: tuple[int, np.ndarray]) -> pd.DataFrame:
    """One row a matrix row, under the number of the partition that made it."""
    part = TaskContext.get().partitionId()
    rows = [(part, m, i, row) for m, matrix in matrices for i, row in enumerate(matrix)]
    return pd.DataFrame(rows, columns=["part", "m", "i", "v"])


def _add_up(table: pa.Table) -> pa.Table:
    """The sum of the arrays of a group, under the number of its group of partitions."""
    total = np.sum([np.asarray(v.values) for v in table.column("v")], axis=0)
    first = {c: table.column(c)[:1] for c in ("part", "m", "i")}
    return pa.table({**first, "v": pa.array([total], pa.list_(pa.float64()))}).cast(pa.schema([("part", pa.int64()), ("m", pa.int32()), ("i", pa.int32()), ("v", pa.list_(pa.float64()))]))


def _collect_partials(df: DataFrame, partitions: int) -> dict[int, np.ndarray]:
    """Add the partial rows up as a tree; only the sums (bounded by the model size) reach
    the driver.  Returns each kind's matrix."""
    while True:
        df = df.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "m", "i").applyInArrow(_add_up, PARTIAL_SCHEMA)
        partitions = -(-partitions // FAN_IN)
        if partitions <= 1:
            break
    rows = df.toArrow().to_pylist()
    return {m: np.array([r["v"] for r in sorted((r for r in rows if r["m"] == m), key=lambda r: r["i"])]) for m in {r["m"] for r in rows}}


def _matrix(parts: dict[int, np.ndarray], m: int, shape: tuple[int, int]) -> np.ndarray:
    return parts.get(m, np.zeros(shape))


def _scalars(parts: dict[int, np.ndarray]) -> dict[int, float]:
    return dict(enumerate(parts[M_SCALAR][0].tolist())) if M_SCALAR in parts else {}


def _pass(X: DataFrame, columns: list[str], part) -> dict[int, np.ndarray]:
    return _collect_partials(X.select(*columns).mapInPandas(part, PARTIAL_SCHEMA), X.rdd.getNumPartitions())


def als_pass(X: DataFrame, H: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """One W-solve over all rows for the given H; returns (W^T W, W^T X, scalars)."""
    spark = X.sparkSession
    k, V = H.shape
    bH = spark.sparkContext.broadcast(H)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Hl = bH.value
        G = Hl @ Hl.T
        WtW = np.zeros((k, k))
        WtX = np.zeros((k, V))
        xx = cross = rows_seen = unsolved = 0.0
        for pdf in batches:
            rows, cols, vals, n = _flatten(pdf)
            B = _x_times(rows, cols, vals, n, Hl.T)
            W, left = _solve_rows(B, G)
            unsolved += left
            WtW += W.T @ W
            WtX += _xt_times(rows, cols, vals, V, W).T
            xx += float(vals @ vals)
            cross += float((W * B).sum())
            rows_seen += n
        scal = np.array([[xx, cross, 0.0, rows_seen, unsolved]])
        yield _rows_of((M_WTW, WtW), (M_WTX, WtX), (M_SCALAR, scal))

    parts = _pass(X, ["indices", "values"], part)
    bH.unpersist()
    return _matrix(parts, M_WTW, (k, k)), _matrix(parts, M_WTX, (k, V)), _scalars(parts)


def fixed_w_pass(X: DataFrame, k: int, n_terms: int, w_of) -> tuple[np.ndarray, np.ndarray]:
    """W^T W and W^T X for a W given row-wise by ``w_of(doc_ids, k)`` (a fixed start)."""

    def part(batches):
        WtW = np.zeros((k, k))
        WtX = np.zeros((k, n_terms))
        for pdf in batches:
            rows, cols, vals, n = _flatten(pdf)
            W = w_of(pdf["doc_id"].to_numpy(), k)
            WtW += W.T @ W
            WtX += _xt_times(rows, cols, vals, n_terms, W).T
        yield _rows_of((M_WTW, WtW), (M_WTX, WtX))

    parts = _pass(X, ["doc_id", "indices", "values"], part)
    return _matrix(parts, M_WTW, (k, k)), _matrix(parts, M_WTX, (k, n_terms))


def cyclic_start_w(doc_ids, k: int) -> np.ndarray:
    """Deterministic positive start ``W0[d, j] = 1 + ((d + j) mod 5) / 4`` (algebra checks)."""
    d = np.asarray(doc_ids, dtype=np.int64)[:, None]
    return 1.0 + ((d + np.arange(k)[None, :]) % 5) * 0.25


def cyclic_start_h(k: int, n_terms: int) -> np.ndarray:
    """Deterministic positive start ``H0[j, v] = 1 + ((j + v) mod 3) / 2``."""
    return 1.0 + ((np.arange(k)[:, None] + np.arange(n_terms)[None, :]) % 3) * 0.5


def multiplicative_h_step(WtW: np.ndarray, WtX: np.ndarray, H: np.ndarray) -> np.ndarray:
    """Lee & Seung update ``H <- H * (W^T X) / (W^T W H)``."""
    den = WtW @ H
    return np.where(den > 0, H * WtX / np.where(den > 0, den, 1.0), 0.0)


def _gram_pass(X: DataFrame, Q: np.ndarray) -> tuple[np.ndarray, dict[int, float]]:
    """X^T X Q (V x p) plus sum(X) and row count, as one job."""
    spark = X.sparkSession
    V, p = Q.shape
    bQ = spark.sparkContext.broadcast(Q)

    def part(batches):
        Ql = bQ.value
        Z = np.zeros((V, p))
        sx = nrows = 0.0
        for pdf in batches:
            rows, cols, vals, n = _flatten(pdf)
            Z += _xt_times(rows, cols, vals, V, _x_times(rows, cols, vals, n, Ql))
            sx += float(vals.sum())
            nrows += n
        yield _rows_of((M_GRAM, Z.T), (M_SCALAR, np.array([[0.0, 0.0, sx, nrows]])))

    parts = _pass(X, ["indices", "values"], part)
    bQ.unpersist()
    return _matrix(parts, M_GRAM, (p, V)).T, _scalars(parts)


def _unorm_pass(X: DataFrame, Vk: np.ndarray, sigma: np.ndarray) -> np.ndarray:
    """Norms of the positive / negative parts of u_j = X v_j / sigma_j -> (k, 2)."""
    spark = X.sparkSession
    k = Vk.shape[1]
    bV = spark.sparkContext.broadcast((Vk, sigma))

    def part(batches):
        Vl, s = bV.value
        acc = np.zeros((k, 2))
        for pdf in batches:
            rows, cols, vals, n = _flatten(pdf)
            U = _x_times(rows, cols, vals, n, Vl) / np.where(s > 0, s, 1.0)
            acc[:, 0] += (np.maximum(U, 0) ** 2).sum(axis=0)
            acc[:, 1] += (np.minimum(U, 0) ** 2).sum(axis=0)
        yield _rows_of((M_UNORM, acc))

    parts = _pass(X, ["indices", "values"], part)
    bV.unpersist()
    return np.sqrt(_matrix(parts, M_UNORM, (k, 2)))


def nndsvda_init(X: DataFrame, k: int, n_terms: int, seed: int = 42, power_iters: int = 3, oversample: int = 8) -> np.ndarray:
    """H0 by NNDSVD with zeros filled by mean(X) ("nndsvda")."""
    rng = np.random.default_rng(seed)
    p = min(n_terms, k + oversample)
    Q, _ = np.linalg.qr(rng.standard_normal((n_terms, p)))
    scal: dict[int, float] = {}
    for _ in range(power_iters):
        Z, scal = _gram_pass(X, Q)
        Q, _ = np.linalg.qr(Z)
    Z, scal = _gram_pass(X, Q)
    Tm = Q.T @ Z
    evals, evecs = np.linalg.eigh((Tm + Tm.T) / 2)
    order = np.argsort(evals)[::-1][:k]
    S = np.sqrt(np.maximum(evals[order], 0.0))
    Vk = Q @ evecs[:, order]  # V x k right singular vectors
    unorm = _unorm_pass(X, Vk, S)
    H = np.zeros((k, n_terms))
    H[0] = np.sqrt(S[0]) * np.abs(Vk[:, 0])
    for j in range(1, k):
        y = Vk[:, j]
        yp, yn = np.maximum(y, 0), np.maximum(-y, 0)
        ypn, ynn = np.linalg.norm(yp), np.linalg.norm(yn)
        xpn, xnn = unorm[j, 0], unorm[j, 1]
        mp, mn = xpn * ypn, xnn * ynn
        if mp > mn:
            v, sig = (yp / ypn if ypn > 0 else yp), mp
        else:
            v, sig = (yn / ynn if ynn > 0 else yn), mn
        H[j] = np.sqrt(S[j] * sig) * v
    H[H < EPS] = 0.0
    n_rows = max(scal.get(S_ROWS, 1.0), 1.0)
    avg = scal.get(S_SUMX, 0.0) / (n_rows * n_terms)
    H[H == 0] = avg
    return H


@dataclass
class NMFResult:
    H: np.ndarray
    n_iter: int
    errors: list[float]
    converged: bool
    unsolved_rows: int

    @property
    def reconstruction_error(self) -> float:
        return self.errors[-1]


def _error(scal: dict[int, float], WtW: np.ndarray, H: np.ndarray) -> float:
    sq = scal.get(S_XX, 0.0) - 2.0 * scal.get(S_CROSS, 0.0) + float((WtW * (H @ H.T)).sum())
    return float(np.sqrt(max(sq, 0.0)))


def fit(X: DataFrame, k: int, n_terms: int, max_iter: int = 500, tol: float = 1e-4, seed: int = 42) -> NMFResult:
    """ML-03.  ``X``: persisted ``(doc_id, indices, values)``."""
    H = nndsvda_init(X, k, n_terms, seed)
    errors: list[float] = []
    it, converged = 0, False
    for it in range(1, max_iter + 1):
        WtW, WtX, scal = als_pass(X, H)
        errors.append(_error(scal, WtW, H))
        H = solve_h(WtW, WtX, H)
        if len(errors) >= 2 and (errors[-2] - errors[-1]) <= tol * errors[-2]:
            converged = True
            break
    # error of the final pair (W of the last pass, updated H) from the same sums:
    # ||X||^2 - 2 <W^T X, H> + <W^T W, H H^T>; no extra pass over X
    sq = scal.get(S_XX, 0.0) - 2.0 * float((WtX * H).sum()) + float((WtW * (H @ H.T)).sum())
    errors.append(float(np.sqrt(max(sq, 0.0))))
    return NMFResult(H, it, errors, converged, int(scal.get(S_UNSOLVED, 0)))


ASSIGN_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("topic_id", T.IntegerType()),
        T.StructField("topic_score", T.DoubleType()),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
    ]
)


def transform(X: DataFrame, H: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """ML-04 + WIN-03: W rows for fixed H, argmax topic and max score per row."""
    spark = X.sparkSession
    bH = spark.sparkContext.broadcast(H)

    def part(batches):
        Hl = bH.value
        G = Hl @ Hl.T
        for pdf in batches:
            rows, cols, vals, n = _flatten(pdf)
            W = solve_rows(_x_times(rows, cols, vals, n, Hl.T), G)
            top = W.argmax(axis=1) if n else np.zeros(0, np.int64)
            yield pd.DataFrame(
                {
                    "doc_id": pdf[id_col].astype("int64").to_numpy(),
                    "topic_id": top.astype(np.int32),
                    "topic_score": W.max(axis=1) if n else np.zeros(0),
                    "weights": list(W),
                }
            )

    return X.select(F.col(id_col), "indices", "values").mapInPandas(part, ASSIGN_SCHEMA).withColumnRenamed("doc_id", id_col)


def topic_terms(spark: SparkSession, H: np.ndarray, vocabulary: DataFrame, top_n: int = 10) -> DataFrame:
    """WIN-02 / ML-06: the ``top_n`` heaviest terms per topic (ties: term index).

    H has k x V entries (bounded by the model), so it enters Spark as a local table."""
    k, V = H.shape
    ti, vi = np.nonzero(H >= 0)
    pdf = pd.DataFrame({"topic_id": ti.astype(np.int32), "term_idx": vi.astype(np.int32), "weight": H[ti, vi]})
    h = spark.createDataFrame(pdf, "topic_id int, term_idx int, weight double")
    w = Window.partitionBy("topic_id").orderBy(F.desc("weight"), F.asc("term_idx"))
    ranked = h.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
    from topicloom.operators.joins import broadcast_if_small

    # top_n x k rows meet the vocabulary; broadcast it only when its size is checked
    return ranked.join(broadcast_if_small(vocabulary.select("term_idx", "term")), "term_idx").select(
        "topic_id", "rank", "term", "weight"
    )


def keyword_table(terms: DataFrame) -> DataFrame:
    """ML-06: (topic_id, keywords array in rank order, keywords joined by ", ")."""
    g = terms.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_kw"))
    kw = F.transform("_kw", lambda x: x["term"])
    return g.select("topic_id", kw.alias("keywords"), F.array_join(kw, ", ").alias("topic_keywords"))
