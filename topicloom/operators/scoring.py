"""Row-local scoring (ML-02, ML-04, WIN-03, JON-04; used by ML-13, ML-14, STR-04).

A row's vector is built inside the row -- tokens, n-grams and a look-up in the fitted
vocabulary, all JVM stages -- and only that sparse vector crosses to an Arrow function,
which solves for the row's topic weights.  Topic, score and keywords are columns added
to the row: no exchange, no join back on an id, so the same code runs on a table and
on a stream.

The vocabulary and H are held by every executor; both are bounded by ``max_features``
(and k).  A model without that bound is scored by ``TfidfModel.transform`` and
``nmf.transform`` instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.operators import nmf, tfidf

_DOUBLES = T.ArrayType(T.DoubleType())
SCORE_TYPE = T.StructType().add("topic_id", T.IntegerType()).add("topic_score", T.DoubleType()).add("weights", _DOUBLES)
ARRAYS_TYPE = T.StructType().add("indices", T.ArrayType(T.IntegerType())).add("values", _DOUBLES)


def _sparse(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries a row, all indices, all values) of a column of sparse MLlib vectors."""
    index, value = vectors.field("indices"), vectors.field("values")
    lens = pc.fill_null(pc.list_value_length(index), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lens, index.flatten().to_numpy(zero_copy_only=False).astype(np.int64), value.flatten().to_numpy(zero_copy_only=False)


def _lists(lens: np.ndarray, flat: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def topic_scorer(spark: SparkSession, H: np.ndarray):
    """A column function: sparse TF-IDF vector -> topic (lowest index on ties), its weight, all weights."""
    held = spark.sparkContext.broadcast(np.ascontiguousarray(H))

    @F.arrow_udf(SCORE_TYPE)
    def score(vectors: pa.Array) -> pa.Array:
        h = held.value
        n, k = len(vectors), h.shape[0]
        lens, cols, vals = _sparse(vectors)
        W = nmf.solve_rows(nmf._x_times(np.repeat(np.arange(n), lens), cols, vals, n, h.T), h @ h.T)
        top = W.argmax(axis=1) if n else np.zeros(0, np.int64)
        weights = _lists(np.full(n, k), W.ravel(), pa.float64())
        return pa.StructArray.from_arrays([pa.array(top, pa.int32()), pa.array(W.max(axis=1) if n else np.zeros(0)), weights], ["topic_id", "topic_score", "weights"])

    return score


@F.arrow_udf(ARRAYS_TYPE)
def vector_arrays(vectors: pa.Array) -> pa.Array:
    """Indices and values of a sparse vector, as arrays."""
    lens, cols, vals = _sparse(vectors)
    return pa.StructArray.from_arrays([_lists(lens, cols, pa.int32()), _lists(lens, vals, pa.float64())], ["indices", "values"])


def row_vectors(docs: DataFrame, text_col: str, model: tfidf.TfidfModel, id_col: str = "doc_id") -> DataFrame:
    """(id, indices, values) of every row, built inside the row (no exchange)."""
    return as_arrays(tfidf.features(docs.select(id_col, text_col), text_col, model, "_v"), "_v", id_col)


def as_arrays(df: DataFrame, vector_col: str, id_col: str = "doc_id") -> DataFrame:
    """(id, indices, values) of a column of sparse vectors."""
    made = df.select(id_col, vector_arrays(vector_col).alias("_a"))
    return made.select(id_col, F.col("_a.indices").alias("indices"), F.col("_a.values").alias("values"))


def keyword_column(keywords: DataFrame, topic: Column, column: str = "topic_keywords") -> Column:
    """The keywords of a topic, from a literal of one entry a topic (k entries)."""
    by_topic = {r["topic_id"]: r[column] for r in keywords.select("topic_id", column).collect()}
    parts = [F.lit(by_topic.get(t)) for t in range(max(by_topic, default=-1) + 1)]
    return F.element_at(F.array(*parts), topic + 1) if parts else F.lit(None)


def score_rows(df: DataFrame, text_col: str, model, keywords: str = "topic_keywords") -> DataFrame:
    """``df`` with topic_id, topic_score and the topic's keywords (columns of these names
    are replaced).  ``model`` is a ``train.TopicModel``; a null text is an empty one, and a
    row without a known term gets topic 0 and score 0."""
    kept = [c for c in df.columns if c not in ("topic_id", "topic_score", keywords)]
    made = tfidf.features(df.select(*kept), text_col, model.tfidf, "_v").withColumn("_s", topic_scorer(df.sparkSession, model.H)("_v"))
    return made.select(
        *kept, F.col("_s.topic_id").alias("topic_id"), F.col("_s.topic_score").alias("topic_score"),
        keyword_column(model.keywords, F.col("_s.topic_id"), keywords).alias(keywords),
    )
