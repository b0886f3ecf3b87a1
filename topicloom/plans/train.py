"""Topic training job (E2): window scan -> training dedup -> usable text ->
TF-IDF -> NMF -> keywords / assignments / metrics."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators import dedup, filters


TRAINING_COLUMNS = ("ord", "ds", "headline", "url", "source_file")


def training_frame(processed: DataFrame, text_column: str = "topic_text", order: str = "ord") -> DataFrame:
    """DDP-02 + FLT-03: dedup across the window, keep rows with usable text,
    expose ``doc_id`` (= source order) for the model."""
    keep = [c for c in (*TRAINING_COLUMNS, *dedup.PLACE, text_column, order) if c in processed.columns]
    df = dedup.drop_training_duplicates(processed.select(*dict.fromkeys(keep)), order)
    df = filters.usable_text(df, text_column)
    return df.withColumn("doc_id", F.col(order))


from dataclasses import dataclass  # noqa: E402

import numpy as np  # noqa: E402
from pyspark import StorageLevel  # noqa: E402

from topicloom.config import TopicModelConfig  # noqa: E402
from topicloom.operators import nmf, tfidf  # noqa: E402
from topicloom.session import land  # noqa: E402


@dataclass
class TopicModel:
    """Fitted topic model: vocabulary (Spark table) + H (k x V ndarray) + metrics."""

    tfidf: tfidf.TfidfModel
    H: np.ndarray
    keywords: DataFrame  # topic_id, keywords, topic_keywords
    terms: DataFrame  # topic_id, rank, term, weight
    reconstruction_error: float
    n_iter: int
    n_docs: int
    converged: bool = True
    unsolved_rows: int = 0

    def vectors(self, docs: DataFrame, text_column: str = "topic_text", id_col: str = "doc_id") -> DataFrame:
        return self.tfidf.transform(docs, text_column, id_col)


def lineage(read: DataFrame, deduped: DataFrame, used: DataFrame) -> dict:
    """ML-16: files and days read (a few a day), and how many rows were read, survived the
    dedup and had text: the dataset a model was made of."""
    by_file = read.groupBy(F.col("ds").cast("string").alias("ds"), F.regexp_extract(F.input_file_name(), "[^/]*$", 0).alias("file")).count()
    files = [(r["ds"], r["file"], r["count"]) for r in by_file.orderBy("ds", "file").collect()]
    return {
        "files": [{"ds": ds, "file": f, "rows": n} for ds, f, n in files],
        "days": sorted({ds for ds, _, _ in files}),
        "rows_read": sum(n for _, _, n in files),
        "rows_after_dedup": deduped.count(),
        "rows_with_text": used.count(),
    }


def fit_topics(docs: DataFrame, config: TopicModelConfig | None = None, features: tfidf.TfidfModel | None = None) -> tuple[TopicModel, DataFrame]:
    """E2 core: TF-IDF fit (unless ``features`` were fitted already) -> NMF fit -> keywords.
    Returns the model and the persisted training matrix X ``(doc_id, indices, values)``."""
    config = config or TopicModelConfig()
    spark = docs.sparkSession
    # Two passes read the texts: term statistics, then vectors (built inside the row).
    narrow = docs.select("doc_id", config.text_column).persist(StorageLevel.MEMORY_AND_DISK)
    tmodel = features or tfidf.fit(narrow, config.text_column, "doc_id", config.tfidf)[0]
    # The iterative fit re-reads X once per pass: written to the shared folder first, so
    # a lost executor re-reads files instead of re-running preprocessing.
    X = land(tmodel.transform(narrow, config.text_column), "topic-vectors").persist(StorageLevel.MEMORY_AND_DISK)
    narrow.unpersist()
    n_docs = X.count()
    res = nmf.fit(X, config.n_topics, tmodel.vocab_size, config.max_iter, config.tol, config.random_state)
    terms = nmf.topic_terms(spark, res.H, tmodel.vocabulary, config.top_n_keywords)
    keywords = nmf.keyword_table(terms)
    model = TopicModel(tmodel, res.H, keywords, terms, res.reconstruction_error, res.n_iter, n_docs, res.converged, res.unsolved_rows)
    return model, X


def load_topic_model(spark: SparkSession, path: str) -> TopicModel:
    """The model that ``sinks.save_topic_model`` wrote: all that scoring needs, from storage alone.

    H comes to the driver whole, as in the fit: topics x vocabulary, both bounded by the
    saved configuration and checked against it."""
    fitted = json.loads(spark.read.text(f"{path}/metadata").first()["value"])["fitted"]
    k, size = fitted["n_topics"], fitted["vocabulary_size"]
    components = spark.read.parquet(f"{path}/components")
    if components.count() != k * size:
        raise ValueError(f"{path}: components don't fit {k} topics and {size} terms")
    h = components.toPandas()
    H = np.zeros((k, size))
    H[h["topic_id"].to_numpy(), h["term_idx"].to_numpy()] = h["weight"].to_numpy()
    features = tfidf.TfidfModel(
        tfidf.TfidfConfig(**fitted["tfidf"]), spark.read.parquet(f"{path}/vocabulary"), fitted["tfidf_docs"], size
    )
    return TopicModel(
        features,
        H,
        spark.read.parquet(f"{path}/keywords"),
        spark.read.parquet(f"{path}/terms"),
        fitted["reconstruction_error"],
        fitted["n_iter"],
        fitted["n_docs"],
        fitted.get("converged", True),
        fitted.get("unsolved_rows", 0),
    )


def assign(model: TopicModel, X: DataFrame) -> DataFrame:
    """WIN-03 + JON-04 + SCL-09: topic id/score per row, keywords of the topic (broadcast, k rows)."""
    a = nmf.transform(X, model.H)
    return a.join(F.broadcast(model.keywords.select("topic_id", "topic_keywords")), "topic_id", "left")  # k rows


def quality(spark, model: TopicModel, assignments: DataFrame) -> DataFrame:
    """ML-05 + AGG-06 + ML-16: one metrics row."""
    return assignments.agg(
        F.lit(float(model.reconstruction_error)).alias("reconstruction_error"),
        F.lit(int(model.tfidf.vocab_size)).alias("vocabulary_size"),
        F.count(F.lit(1)).alias("training_rows"),
        F.lit(int(model.H.shape[0])).alias("n_topics"),
        F.avg("topic_score").alias("mean_topic_score"),
        F.lit(int(model.n_iter)).alias("iterations"),
    )
