"""k-means baseline (ML-07..09, SCL-18).

Fitting is MLlib's ``KMeans`` (k-means|| init, distributed Lloyd iterations);
inertia is the model's training cost.  Assignment to *given* centres is a pure
column expression: the centres are a k x d literal (bounded by k), distances
are ``aggregate(zip_with(...))`` over the vector array, argmin by
``array_position``.  The batch-relative confidence ``1 - d / max(d)`` needs one
global maximum, fetched as a scalar aggregate (no single-partition window).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit(df: DataFrame, features: str, k: int, seed: int = 42, max_iter: int = 500, tol: float = 1e-4):
    """ML-07: MLlib k-means; returns the fitted model (``summary.trainingCost`` = inertia)."""
    km = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol=features, predictionCol="cluster_id", initMode="k-means||")
    return km.fit(df)


def as_vector(col: str) -> Column:
    return array_to_vector(F.col(col))


def distances_to(vec: Column, centers: np.ndarray) -> Column:
    """Euclidean distance from an array<double> column to each literal centre."""
    lits = [F.array(*[F.lit(float(x)) for x in c]) for c in centers]
    dists = [
        F.sqrt(F.aggregate(F.zip_with(vec, c, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)), F.lit(0.0), lambda acc, x: acc + x))
        for c in lits
    ]
    return F.array(*dists)


def assign(df: DataFrame, vec_col: str, centers: np.ndarray) -> DataFrame:
    """ML-08: nearest centre (lowest index on ties), its distance and SCL-18 confidence."""
    d = distances_to(F.col(vec_col), centers)
    out = df.withColumn("_d", d).withColumn("distance", F.array_min("_d"))
    out = out.withColumn("cluster_id", (F.array_position("_d", F.col("distance")) - 1).cast("int")).drop("_d")
    max_d = out.agg(F.max("distance")).first()[0] or 0.0
    conf = F.lit(1.0) if max_d == 0 else F.lit(1.0) - F.col("distance") / F.lit(float(max_d))
    return out.withColumn("cluster_score", conf)


def centroids(df: DataFrame, vec_col: str, label_col: str) -> tuple[list, np.ndarray]:
    """Mean vector per label (k x d, bounded by the number of labels)."""
    long = df.select(label_col, F.posexplode(vec_col).alias("pos", "x"))
    means = long.groupBy(label_col, "pos").agg(F.avg(F.col("x").cast("double")).alias("m")).collect()
    labels = sorted({r[label_col] for r in means})
    dim = max(r["pos"] for r in means) + 1
    C = np.zeros((len(labels), dim))
    index = {lab: i for i, lab in enumerate(labels)}
    for r in means:
        C[index[r[label_col]], r["pos"]] = r["m"]
    return labels, C


def center_keywords(model, vocabulary: DataFrame, top_n: int = 10) -> DataFrame:
    """ML-09: top-weighted vocabulary terms of each centre."""
    from topicloom.operators.nmf import topic_terms

    C = np.vstack(model.clusterCenters())
    return topic_terms(vocabulary.sparkSession, C, vocabulary, top_n).withColumnRenamed("topic_id", "cluster_id")


def batch_confidence(assigned: DataFrame, dist_col: str = "distance") -> DataFrame:
    """SCL-18 for an MLlib assignment: 1 - d / max(d) over the batch (all 1.0 if max is 0)."""
    max_d = assigned.agg(F.max(dist_col)).first()[0] or 0.0
    conf = F.lit(1.0) if max_d == 0 else F.lit(1.0) - F.col(dist_col) / F.lit(float(max_d))
    return assigned.withColumn("cluster_score", conf)


def assign_sparse(X: DataFrame, centers: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """ML-08 on sparse rows ``(id, indices, values)``: nearest centre (lowest index
    on ties, as MLlib) and its Euclidean distance, ``||x||^2 - 2 x.c + ||c||^2``
    per Arrow batch; the k x V centres are broadcast (bounded by the model)."""
    import pandas as pd

    from topicloom.operators.nmf import _flatten, _x_times

    spark = X.sparkSession
    bC = spark.sparkContext.broadcast(np.asarray(centers, dtype=np.float64))
    schema = f"{id_col} long, cluster_id int, distance double"

    def part(batches):
        C = bC.value
        cc = (C * C).sum(axis=1)
        for pdf in batches:
            rows, cols, vals, n = _flatten(pdf)
            xc = _x_times(rows, cols, vals, n, C.T)
            xx = np.bincount(rows, weights=vals * vals, minlength=n) if len(vals) else np.zeros(n)
            d2 = np.maximum(xx[:, None] - 2 * xc + cc[None, :], 0.0)
            best = d2.argmin(axis=1) if n else np.zeros(0, np.int64)
            yield pd.DataFrame(
                {id_col: pdf[id_col].astype("int64").to_numpy(), "cluster_id": best.astype(np.int32), "distance": np.sqrt(d2[np.arange(n), best]) if n else np.zeros(0)}
            )

    return X.select(id_col, "indices", "values").mapInPandas(part, schema)
