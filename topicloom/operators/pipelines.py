"""SNK-04 for the text baselines: one artefact that takes a text to a prediction.

A fitted TF-IDF is written as MLlib stages -- tokens, stop words, n-grams, vocabulary,
idf, norm -- followed by the fitted k-means or logistic regression, as one
``PipelineModel``.  Each run saves under a version of its own; a version is complete
once its ``metadata`` file is there, and ``load`` takes the newest complete one unless it
is told which.  Loading needs the path alone, in any session.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import NGram, RegexTokenizer, SQLTransformer, StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators import tfidf

#: Columns that the stages add on the way.
STAGE_COLUMNS = ("_text", "_tok", "_words", "_tf", "_tfidf", "terms")


def text_stages(model: tfidf.TfidfModel, text_col: str, features: str = "features") -> list:
    """The fitted TF-IDF from a text column (null: empty) to a sparse vector."""
    config = model.config
    stages = [
        SQLTransformer(statement=f"SELECT *, coalesce(`{text_col}`, '') AS _text FROM __THIS__"),
        RegexTokenizer(pattern=config.token_pattern, gaps=False, toLowercase=False, inputCol="_text", outputCol="_tok"),
    ]
    words = "_tok"
    if config.stop_words:
        stages.append(StopWordsRemover(inputCol="_tok", outputCol="_words", stopWords=list(tfidf.english_stop_words()), caseSensitive=True))
        words = "_words"
    parts = []
    for n in range(config.ngram_min, config.ngram_max + 1):
        if n > 1:
            stages.append(NGram(n=n, inputCol=words, outputCol=f"_ng{n}"))
        parts.append(words if n == 1 else f"_ng{n}")
    stages.append(SQLTransformer(statement=f"SELECT *, concat({', '.join(parts)}) AS terms FROM __THIS__"))
    return stages + list(tfidf.feature_model(model, "terms", features).stages)


def save(spark: SparkSession, path: str, version: str, stages: list, metadata: dict) -> PipelineModel:
    """Write the stages as version ``version`` below ``path``; returns the reloaded model (a
    model fitted here keeps a summary, which can't go into tasks)."""
    model = PipelineModel(stages=stages)
    model.write().overwrite().save(f"{path}/{version}/pipeline")
    text = spark.createDataFrame([(json.dumps(metadata | {"version": version}, default=str),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/{version}/metadata")
    return PipelineModel.load(f"{path}/{version}/pipeline")


def versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest name first."""
    try:
        found = spark.read.format("text").load(f"{path}/*/metadata").select(F.element_at(F.split("_metadata.file_path", "/"), -3).alias("v"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted({r["v"] for r in found.distinct().collect()})  # one a saved run


def load(spark: SparkSession, path: str, version: str | None = None) -> tuple[PipelineModel, dict]:
    """The model of a version (the newest) and its metadata."""
    if version is None:
        known = versions(spark, path)
        if not known:
            raise FileNotFoundError(f"no saved pipeline below {path}")
        version = known[-1]
    meta = json.loads(spark.read.text(f"{path}/{version}/metadata").first()["value"])
    return PipelineModel.load(f"{path}/{version}/pipeline"), meta


def score(model: PipelineModel, df: DataFrame, *outputs: str) -> DataFrame:
    """``df`` with the named output columns of the model."""
    return model.transform(df).select(*df.columns, *outputs)
