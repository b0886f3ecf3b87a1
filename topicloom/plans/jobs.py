"""End-to-end jobs, handing off through ds-partitioned Parquet.

``preprocess_day``  landed raw articles -> processed articles (E1)
``train_window``    processed window -> TF-IDF + NMF model + assignments + metrics (E2)
``score_day``       processed day(s) + model -> predictions (E3, ML-13)
``report_day``      predictions -> dashboard tables (E3)
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.config import TopicModelConfig
from topicloom.functions import dates
from topicloom.operators import dedup, filters, regions, report, scoring
from topicloom.plans import preprocess as P
from topicloom.plans import train as TR
from topicloom.sources import feeds as FD
from topicloom.sources import sinks as SK


def preprocess_day(spark: SparkSession, raw_path: str, out_path: str, run_date: str | None = None) -> dict[str, int]:
    """E1: one day (or, without ``run_date``, every landed day, each deduplicated
    within its own day as the per-file reference does) -> processed partitions.

    Returns DDP-05 counters collected with ``observe`` during the write itself
    (no extra pass): rows read, rows with a headline, rows written."""
    from pyspark.sql import Observation

    if run_date:  # SRC-08: a day that was not landed, or is empty, is an error
        raw = dedup.with_file_row(FD.read_day(spark, raw_path, run_date))
        filters.require_rows(raw, f"no raw rows on {run_date}")
    else:
        raw = dedup.with_file_row(spark.read.parquet(raw_path)).withColumn("ds", F.col("ds").cast("string"))
    seen, kept = Observation("raw_rows"), Observation("kept_rows")
    raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("headline").alias("with_headline"))
    cleaned = P.add_clean_columns(dedup.clean_articles(raw, scope=["ds"]))
    out = P.processed_columns(P.add_features(cleaned)).observe(kept, F.count(F.lit(1)).alias("rows"))
    if not SK.write_partitioned(out, out_path, ["ds"], skip_empty=False):
        return {"rows_in": 0, "rows_with_headline": 0, "rows_out": 0, "removed_duplicates": 0}
    s_in, s_out = seen.get, kept.get
    return {
        "rows_in": int(s_in.get("rows", 0)),
        "rows_with_headline": int(s_in.get("with_headline", 0)),
        "rows_out": int(s_out.get("rows", 0)),
        "removed_duplicates": int(s_in.get("with_headline", 0)) - int(s_out.get("rows", 0)),
    }


def train_window(
    spark: SparkSession,
    processed_path: str,
    model_path: str | None,
    run_date: str | None = None,
    config: TopicModelConfig | None = None,
    start: str | None = None,
    assignments_path: str | None = None,
    stats_path: str | None = None,
) -> tuple[TR.TopicModel, DataFrame]:
    """E2: rolling window ending at ``run_date`` (``config.window_days`` days; all
    days when ``run_date`` is None) -> fitted model and training assignments.

    An empty window and one without usable text are errors; days of the window
    without data are listed in the saved metadata.  With ``stats_path`` (see
    ``count_day``) the vocabulary comes from the days' term counts, without a pass
    over the window's texts.  The metadata record what the model was made of (ML-16):
    files and days read, rows before and after dedup and the text filter."""
    from topicloom.operators import window_terms

    config = config or TopicModelConfig()
    df = dedup.with_file_row(spark.read.parquet(processed_path)).withColumn("ds", F.col("ds").cast("string"))
    if run_date:
        first = start or spark.range(1).select(dates.window_start(F.lit(run_date), config.window_days).cast("string")).first()[0]
        df = dedup.with_file_row(FD.read_window(spark, processed_path, first, run_date)).withColumn("ds", F.col("ds").cast("string"))
        filters.require_rows(df, f"no processed rows from {first} to {run_date}")
        absent = [str(r["day"]) for r in FD.missing_days(spark, df, first, run_date).orderBy("day").collect()]  # days of one window
    else:
        absent = []
    # DDP-02 across the window in file (day) order, then FLT-03
    narrow = df.select(*dedup.PLACE, "ord", "ds", "headline", "url", config.text_column)
    kept = dedup.drop_training_duplicates(narrow.withColumn("_o", F.struct("ds", "ord")), "_o").drop("_o")
    docs = filters.usable_text(kept, config.text_column).withColumn("doc_id", F.col("ord"))
    filters.require_rows(docs, f"no row has text in {config.text_column!r}")
    features = None
    if stats_path:
        if not run_date:
            raise ValueError("the counts of a window need its run_date")
        features = window_terms.fit(window_terms.window_stats(spark, stats_path, first, run_date), config.tfidf)
    model, X = TR.fit_topics(docs, config, features)
    lineage = TR.lineage(df, kept, docs)
    assignments = TR.assign(model, X)
    if assignments_path:
        # SNK-03: training assignments with their processed columns
        cols = kept.select("ord", "ds", "headline", "url", config.text_column)
        out = cols.join(assignments.withColumnRenamed("doc_id", "ord").drop("weights"), "ord")
        SK.write_partitioned(out, assignments_path, ["ds"])
    if model_path:
        meta = {
            "run_date": run_date,
            "lineage": lineage,
            "missing_days": absent,
            "algorithm": config.algorithm,
            "n_topics": config.n_topics,
            "text_column": config.text_column,
            "reconstruction_error": model.reconstruction_error,
            "vocabulary_size": model.tfidf.vocab_size,
            "config": asdict(config),
        }
        SK.save_topic_model(spark, model, model_path, meta)
    return model, assignments


def count_day(spark: SparkSession, processed_path: str, stats_path: str, run_date: str, config: TopicModelConfig | None = None) -> None:
    """ML-15: add one processed day to the term counts of the sliding training window."""
    from topicloom.operators import window_terms

    df = dedup.with_file_row(spark.read.parquet(processed_path).where(F.col("ds") == run_date))
    window_terms.add_days(df, stats_path, run_date, run_date, config)


def score_day(
    spark: SparkSession, processed_path: str, model: TR.TopicModel | str, out_path: str | None, run_date: str | None = None
) -> DataFrame:
    """E3 / ML-13: processed rows + topic_id, topic_score, topic_keywords.  ``model`` is a
    fitted model or the path of a saved one.  Rows are scored where they are: no
    shuffle, whatever the number of days."""
    if isinstance(model, str):
        model = TR.load_topic_model(spark, model)
    if run_date:
        df = FD.read_day(spark, processed_path, run_date)
    else:
        df = spark.read.parquet(processed_path).withColumn("ds", F.col("ds").cast("string"))
    pred = scoring.score_rows(df, "topic_text", model)
    if out_path:
        SK.write_partitioned(pred, out_path, ["ds"], skip_empty=False)
    return pred


def sketch_days(spark: SparkSession, predictions_path: str, sketches_path: str, run_date: str | None = None) -> None:
    """AGG-03: the KPI sketches of one predicted day (or of all), one small row a day."""
    pred = FD.read_day(spark, predictions_path, run_date) if run_date else spark.read.parquet(predictions_path)
    SK.write_partitioned(report.kpi_sketches(FD.load_predictions(pred.drop("published_at_parsed"))), sketches_path, ["ds"], skip_empty=False)


def kpi_range(spark: SparkSession, sketches_path: str, start: str, end: str) -> DataFrame:
    """AGG-03 over the days from ``start`` to ``end``: reads their sketches, no article."""
    days = spark.read.parquet(sketches_path).withColumn("ds", F.col("ds").cast("string"))
    return report.kpis_from_sketches(days.where((F.col("ds") >= start) & (F.col("ds") <= end)))


def report_day(spark: SparkSession, predictions_path: str, run_date: str | None = None) -> dict[str, DataFrame]:
    """E3 dashboard tables for one date (default: the newest)."""
    day = FD.load_predictions(FD.read_day(spark, predictions_path, run_date).drop("published_at_parsed"))
    geo = regions.add_coordinates(day, dashboard=True)
    return {
        "topics": report.topic_summary(day),
        "regions": report.map_layer(report.region_counts(geo)),
        "headlines": report.top_headlines(day),
        "articles": report.article_links(day),
        "kpis": report.kpis(day),
    }
