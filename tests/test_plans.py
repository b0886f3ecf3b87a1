"""Physical-plan checks: the plans we want, not just the answers."""

import re

import pytest
from pyspark.sql import functions as F

from topicloom.operators import dedup, report
from topicloom.plans import preprocess as P
from topicloom.plans import registry as R
from topicloom.sources import feeds as FD
from topicloom.sources import sinks
from topicloom.sources.testdata import articles
from topicloom.streaming.stream import scratch


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def static_plans(spark):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", prev)


def _shuffles(p: str) -> int:
    return p.count("Exchange hashpartitioning") + p.count("Exchange rangepartitioning") + p.count("Exchange SinglePartition")


def test_article_dedup_two_exchanges(spark, smoke_dir, static_plans):
    p = plan(dedup.clean_articles(articles(spark, smoke_dir)))
    assert _shuffles(p) == 2


def test_preprocess_stays_in_jvm(spark, smoke_dir, static_plans):
    p = plan(P.preprocess(articles(spark, smoke_dir)))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BroadcastHashJoin" in p  # coordinates
    assert _shuffles(p) == 2  # only the two dedup passes


def test_window_scan_prunes_partitions(spark, smoke_dir, static_plans):
    path = scratch(spark, "plan-window")
    sinks.write_partitioned(articles(spark, smoke_dir), path, ["ds"])
    p = plan(FD.read_window(spark, path, "2024-01-08", "2024-01-10"))
    assert "PartitionFilters: [isnotnull(ds" in p and "2024-01-08" in p


def test_top_headlines_limits_before_shuffle(spark, smoke_dir, static_plans):
    p = plan(report.top_headlines(R.standin_predictions(spark, smoke_dir)))
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_feed_join_is_broadcast(spark, smoke_dir, static_plans):
    from topicloom.sources import testdata as TD

    p = plan(FD.join_feed(TD.rss_items(spark, smoke_dir), TD.feeds(spark, smoke_dir)))
    assert "BroadcastHashJoin" in p and "CartesianProduct" not in p


def test_term_counts_without_shuffle(spark, smoke_dir, static_plans):
    from topicloom.operators import tfidf as TF

    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").select(F.col("doc_id"), F.col("text"))
    tf = TF.term_counts(docs, "text", "doc_id")
    assert _shuffles(plan(tf)) == 0  # counted inside each row
    model, tf = TF.fit(docs, "text", "doc_id")
    p = plan(TF.vectors(tf, model))
    # one exchange, after a map-side partial collect_list (one row per document)
    assert _shuffles(p) == 1 and p.count("ObjectHashAggregate") == 2


def test_scan_reads_only_needed_columns(spark, smoke_dir, static_plans):
    p = plan(R.QUERIES["region_tags"](spark, smoke_dir))
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string,_\w*row_index:bigint>", p)  # the row's place, too


def test_article_dedup_scans_input_once(spark, smoke_dir, static_plans):
    p = plan(dedup.clean_articles(articles(spark, smoke_dir)))
    assert p.count("FileScan parquet") == 1
