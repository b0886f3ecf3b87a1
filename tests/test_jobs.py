"""E1-E3 jobs end to end on sf0.001, handing off through Parquet."""

import pytest
from pyspark.sql import functions as F

from topicloom.plans import jobs
from topicloom.sources import sinks
from topicloom.sources.testdata import articles
from topicloom.streaming.stream import scratch


def test_daily_jobs(spark, smoke_dir):
    raw, processed, model_dir, preds = (scratch(spark, n) for n in ("t-raw", "t-processed", "t-model", "t-pred"))
    sinks.write_partitioned(articles(spark, smoke_dir), raw, ["ds"])
    stats = jobs.preprocess_day(spark, raw, processed)
    p = spark.read.parquet(processed)
    assert stats["rows_out"] == p.count() and stats["rows_in"] == articles(spark, smoke_dir).count()
    assert stats["removed_duplicates"] == stats["rows_with_headline"] - stats["rows_out"] >= 0
    assert p.count() > 0 and {"region", "topic_text", "headline_clean"} <= set(p.columns)
    assign_dir = scratch(spark, "t-assign")
    model, assigned = jobs.train_window(spark, processed, model_dir, assignments_path=assign_dir)
    assert spark.read.parquet(assign_dir).count() == model.n_docs
    assert model.H.shape[0] == 6 and (model.H >= 0).all()
    assert assigned.count() == model.n_docs
    pred = jobs.score_day(spark, processed, model, preds)
    assert pred.count() == p.count()
    columns = ["ord", "ds", "topic_id", F.round("topic_score", 9).alias("score"), "topic_keywords"]
    again = jobs.score_day(spark, processed, model_dir, None)
    assert sorted(map(tuple, again.select(*columns).collect()), key=str) == sorted(map(tuple, pred.select(*columns).collect()), key=str)
    tables = jobs.report_day(spark, preds)
    topics = tables["topics"].collect()
    assert sum(r["count"] for r in topics) == tables["kpis"].first()["articles"]
    assert spark.read.parquet(f"{model_dir}/vocabulary").count() == model.tfidf.vocab_size

    with pytest.raises(ValueError, match="no processed rows"):
        jobs.train_window(spark, processed, None, run_date="1990-01-01")
