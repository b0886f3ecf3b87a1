"""Operator 7: nearest neighbours with vantage-point trees per shard.

Vectors are scaled to length one; Euclidean distance then falls as cosine rises and
obeys the triangle inequality.  Every shard is a bounded number of vectors, picked by
hash, with a vantage-point tree over them.  Queries come in bounded blocks; every
(shard, block) pair is one group, so no task ever holds more than a shard and a block.

In a tree a query first goes down to one leaf, which gives its first radius; then one
pass over the nodes visits each for all queries whose ball may reach it.  ``factor``
relaxes pruning: a node is skipped if its lower bound exceeds radius / factor ...
times one, that is ``bound * factor > radius``; with factor 1 the search is exact.

Equal vectors are one entry of the index, with their k + 1 smallest ids: ties go to
smaller ids, and a query loses at most itself, so no other id of theirs can appear.

Defined results: vectors that are null, zero, empty or hold null or non-finite
components take no part; vectors of unlike lengths are searched apart, each among
its own; rows with equal (vec_id, vector) count once; a null vec_id takes no part;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.llm.common import land

K = 5
SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF = 64
#: Slack of the pruning test for rounding of distances.
EPS = 1e-7
SALTS = 16


class VpTree:
    """A tree over unit vectors: inner nodes hold a vantage point and the distance
    ranges of their two halves, leaves hold rows."""

    def __init__(self, unit: np.ndarray, leaf: int = LEAF, seed: int = 0):
        self.unit = unit
        self.nodes: list[tuple] = []
        self.leaf = leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(unit)))

    def _build(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= self.leaf:
            self.nodes[at] = ("leaf", rows)
            return at
        point = self.unit[rows[self.rng.integers(len(rows))]]
        d = distances(self.unit[rows], point[None])[:, 0]
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        spans = (d[near[0]], d[near[-1]], d[far[0]], d[far[-1]])
        self.nodes[at] = ("split", point, spans, self._build(rows[near]), self._build(rows[far]))
        return at

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> list[np.ndarray]:
        """For each query the rows that may be among its k nearest (k or more, if there are)."""
        n = len(queries)
        best = np.full((n, k), np.inf)
        # Down to one leaf each, for a first radius.
        stack = [(self.root, np.arange(n))]
        while stack:
            at, qs = stack.pop()
            node = self.nodes[at]
            if node[0] == "leaf":
                d = distances(queries[qs], self.unit[node[1]])
                best[qs] = np.sort(np.concatenate([best[qs], d], 1), 1)[:, :k]
                continue
            _, point, (_, hi, lo, _), near, far = node
            to = distances(queries[qs], point[None])[:, 0] <= (hi + lo) / 2
            stack += [(c, qs[s]) for c, s in ((near, to), (far, ~to)) if s.any()]
        radius = best[:, -1]
        best = np.full((n, k), np.inf)
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n)]
        stack = [(self.root, np.arange(n))]
        while stack:
            at, qs = stack.pop()
            node = self.nodes[at]
            if node[0] == "leaf":
                d = distances(queries[qs], self.unit[node[1]])
                best[qs] = np.sort(np.concatenate([best[qs], d], 1), 1)[:, :k]
                radius[qs] = np.minimum(radius[qs], best[qs, -1])
                for q, row in zip(qs, d):
                    hit = np.flatnonzero(row <= radius[q] + EPS)
                    found[q].append((node[1][hit], row[hit]))
                continue
            _, point, (a, b, c, e), near, far = node
            d = distances(queries[qs], point[None])[:, 0]
            for child, lo, hi in ((far, c, e), (near, a, b)):
                bound = np.maximum(np.maximum(lo - d, d - hi), 0)
                go = bound * factor <= radius[qs] + EPS
                if go.any():
                    stack.append((child, qs[go]))
        out = []
        for q in range(n):
            rows = [r[d <= radius[q] + EPS] for r, d in found[q]]
            out.append(np.concatenate(rows) if rows else np.empty(0, int))
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal rows give equal results."""
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors, in double precision."""
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(F.size("v") > 0).where(ok)


def build_index(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """(shard, v, ids) with one row for each distinct vector, and the number of shards.

    The ids of a vector are cut to the k + 1 smallest in two steps, salted first, so
    a vector that many rows share is nowhere gathered."""
    rows = valid_vectors(vectors).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for by in (["v", "salt"], ["v"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))
        rows = rows.select("v", "salt", "vec_id").distinct() if "salt" in by else rows
        rows = rows.withColumn("r", rank).where(F.col("r") <= k + 1).drop("r")
    entries = land(rows.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vp-entries")
    n = entries.count()
    shards = max(1, -(-n // shard_rows))
    return entries.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int")), shards


def search(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = 1.0, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of ``vectors`` for each row of ``queries``."""
    index, shards = build_index(vectors, k, shard_rows)
    asked = land(valid_vectors(queries).select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv")).distinct(), "vp-queries")
    blocks = max(1, -(-asked.count() // block_rows))
    index = index.withColumn("dim", F.size("v")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("dim", F.size("qv")).withColumn("block", F.pmod(F.xxhash64("query_id", "qv"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        v, q = (np.array(t.column(c).combine_chunks().flatten()).reshape(t.num_rows, -1) for t, c in ((left, "v"), (right, "qv")))
        ids = left.column("ids").to_pylist()
        qid = right.column("query_id").to_pylist()
        # Scaling by the largest component first keeps the squares within range.
        unit, qu = (x / np.abs(x).max(1, keepdims=True) for x in (v, q))
        unit, qu = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (unit, qu))
        near = VpTree(unit).search(qu, k + 1, factor)
        out_q, out_v, out_s = [], [], []
        for i, rows in enumerate(near):
            score = cosine(v[rows], np.repeat(q[i : i + 1], len(rows), 0))
            best = sorted(((-s, x) for s, r in zip(score.tolist(), rows.tolist()) for x in ids[r] if x != qid[i]))[:k]
            out_q += [qid[i]] * len(best)
            out_v += [x for _, x in best]
            out_s += [-s for s, _ in best]
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})

    by = ["shard", "block", "dim"]
    found = index.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(one, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def brute_force(vectors: pd.DataFrame, k: int = K, every: int = 50) -> pd.DataFrame:
    """All pairs in numpy, for tests and recall."""
    ids, v = vectors["vec_id"].to_numpy(), np.stack(vectors["embedding"].to_numpy()).astype(float)
    out = []
    for i in np.flatnonzero(ids % every == 0):
        score = cosine(v, np.repeat(v[i : i + 1], len(v), 0))
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out += [(ids[i], r, ids[j], score[j]) for r, j in enumerate(order, 1)]
    return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])
