"""Supervised text classifier (ML-10..12, AGG-05).

* ML-11 stratified split: each row gets a deterministic 32-bit hash of its key
  (multiplicative, a bijection on 32-bit keys); per class the ``round(test_size
  * n_c)`` smallest hashes form the test set.  One class may hold most rows,
  so no per-class sort runs in one task: the cut-off hash of each class is
  found by a two-pass selection -- bucket counts (partially aggregated), then
  the exact rank inside the single boundary bucket.
* ML-10 class weights ``n / (k * n_c)`` ("balanced") and an MLlib logistic
  regression (binomial for two classes, multinomial beyond) whose objective
  equals the L2 (C = 1) one:
  ``regParam = 1 / sum(weights)``, no standardisation.
* ML-12 report from the confusion counts (a k x k table), undefined ratios -> 0.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_MULT = 2654435761
HASH_MOD = 1 << 32
BUCKET_BITS = 16


def split_hash(key: Column, seed: int) -> Column:
    """Ids are reduced below 2^31 first, so the product of any long id fits."""
    return (F.pmod(key.cast("long"), F.lit(1 << 31)) * F.lit(HASH_MULT) + F.lit(seed)) % F.lit(HASH_MOD)


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` ('train' / 'test') keeping class shares in both parts.

    The statistics run on a narrow persisted (label, hash) table; the result is
    a projection of ``df`` with the per-class cut-off hashes as a literal map
    (one entry per class), so no join is needed."""
    from pyspark import StorageLevel
    from pyspark.sql import Window

    spark = df.sparkSession
    h = split_hash(F.col(key), seed)
    narrow = df.select(F.col(label), h.alias("_h")).withColumn("_b", F.shiftright("_h", 32 - BUCKET_BITS))
    narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    counts = narrow.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("n")).collect()
    per_class: dict = {}
    for r in counts:
        per_class.setdefault(r[label], []).append((r["_b"], r["n"]))
    targets = {}
    for c, buckets in per_class.items():
        n_c = sum(n for _, n in buckets)
        n_test = int(math.floor(test_size * n_c + 0.5))
        seen = 0
        for b, n in sorted(buckets):
            if n_test > 0 and seen + n >= n_test:
                targets[c] = (b, n_test - seen)
                break
            seen += n
    cuts: dict = {}
    if targets:
        # exact cut-off inside each class's boundary bucket: only those rows are ranked
        boundary = spark.createDataFrame([(c, b, k) for c, (b, k) in targets.items()], f"{_ddl(df, label)}, _b long, _k long")
        ranked = narrow.join(F.broadcast(boundary), [label, "_b"]).select(label, "_h", "_k")
        w = Window.partitionBy(label).orderBy("_h")
        cut = ranked.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == F.col("_k"))
        cuts = {r[label]: r["_h"] for r in cut.select(label, "_h").collect()}
    narrow.unpersist()
    cut_of = F.lit(-1).cast("long")
    for c, v in cuts.items():
        cut_of = F.when(F.col(label) == F.lit(c), F.lit(int(v))).otherwise(cut_of)
    return df.withColumn("split", F.when(h <= cut_of, "test").otherwise("train"))


def _ddl(df: DataFrame, column: str) -> str:
    return f"{column} {df.schema[column].dataType.simpleString()}"


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` per class."""
    from pyspark.sql import Window

    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    all_rows = Window.partitionBy()  # over the k-row count table only
    return counts.withColumn(
        "weight", F.sum("n_c").over(all_rows) / (F.count(F.lit(1)).over(all_rows) * F.col("n_c"))
    )


def fit_logistic(train: DataFrame, features: str, label: str, max_iter: int = 1000, tol: float = 1e-4):
    """ML-10: weighted logistic regression (objective of C = 1, L2)."""
    weights = class_weights(train, label).select(label, "weight")
    data = train.join(F.broadcast(weights), label)  # k rows
    total_w = data.agg(F.sum("weight")).first()[0]
    lr = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        weightCol="weight",
        family="auto",  # binomial for two classes, multinomial beyond: the reference library's rule
        regParam=1.0 / total_w,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,  # the reference solver's default tolerance
    )
    return lr.fit(data)


def persist_model(model, path: str):
    """SNK-04: write the fitted model and use the reloaded copy for scoring.

    The reloaded model has no training summary; a summary keeps a reference to
    the session, which cannot be serialised into tasks once the session has
    used ``Observation`` metrics."""
    from pyspark.ml.classification import LogisticRegressionModel

    model.write().overwrite().save(path)
    return LogisticRegressionModel.load(path)


def report(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """ML-12: per-class precision/recall/F1/support, then accuracy, macro and weighted averages."""
    conf = pred.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    tp = conf.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    sup = conf.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    prd = conf.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = sup.join(prd, "cls", "full").join(tp, "cls", "left").fillna(0, subset=["tp", "support", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    per = per.withColumn("f1", f1)
    classes = per.select(
        F.col("cls").alias("label"), "precision", "recall", "f1", F.col("support").cast("long").alias("support")
    )
    n = F.sum("support")
    summary = per.agg(
        (F.sum("tp") / n).alias("accuracy"),
        F.avg("precision").alias("mp"),
        F.avg("recall").alias("mr"),
        F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / n).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("wf"),
        n.cast("long").alias("n"),
    )
    acc = summary.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"), "n")
    macro = summary.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"), F.col("mf").alias("f1"), "n")
    weighted = summary.select(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"), F.col("wr").alias("recall"), F.col("wf").alias("f1"), "n")
    tail = acc.unionByName(macro).unionByName(weighted).withColumnRenamed("n", "support")
    return classes.unionByName(tail)
