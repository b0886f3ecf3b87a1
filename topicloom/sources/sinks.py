"""Sinks (SNK-01..05).

Dated outputs are Parquet partitioned by ``ds`` with dynamic partition
overwrite: rewriting one day replaces that day only, and nothing is written
for an empty input (as the collectors do).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], skip_empty: bool = True) -> bool:
    """SNK-01..03: overwrite only the partitions present in ``df``; returns False when empty."""
    if skip_empty and df.isEmpty():
        return False
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
    return True


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export of a table (header, quoted multi-line text)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def save_topic_model(spark: SparkSession, model, path: str, metadata: dict) -> None:
    """SNK-04: vocabulary, H (long form) and keywords as Parquet + metadata JSON.

    The metadata also hold what ``train.load_topic_model`` needs to rebuild the model."""
    from dataclasses import asdict

    import numpy as np
    import pandas as pd

    fitted = {
        "tfidf": asdict(model.tfidf.config),
        "vocabulary_size": model.tfidf.vocab_size,
        "n_topics": int(model.H.shape[0]),
        "n_docs": model.n_docs,
        "tfidf_docs": model.tfidf.n_docs,
        "n_iter": model.n_iter,
        "converged": model.converged,
        "unsolved_rows": model.unsolved_rows,
        "reconstruction_error": model.reconstruction_error,
    }
    metadata = metadata | {"fitted": fitted}

    model.tfidf.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
    ti, vi = np.indices(model.H.shape)
    h = pd.DataFrame({"topic_id": ti.ravel().astype("int32"), "term_idx": vi.ravel().astype("int32"), "weight": model.H.ravel()})
    components = spark.createDataFrame(h, "topic_id int, term_idx int, weight double")
    components.write.mode("overwrite").parquet(f"{path}/components")
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    model.keywords.write.mode("overwrite").parquet(f"{path}/keywords")
    meta = spark.createDataFrame([(json.dumps(metadata, default=str),)], "metadata string")
    meta.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def append_metrics(df: DataFrame, path: str, run_id: str) -> None:
    """SNK-05: metrics rows appended as ``(run_id, metric, value)``."""
    cols = [c for c in df.columns]
    long = df.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[F.col(c).cast("double") for c in cols]))).alias("metric", "value"))
    long.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)
