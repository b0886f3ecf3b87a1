"""A sample of registered queries against their DuckDB oracles at sf0.001."""

import duckdb
import pytest

from topicloom.sources.testdata import TABLES

SAMPLE = ["clean_headlines", "article_dedup", "region_tags", "topic_text", "top_headlines", "tfidf", "stratified_split", "page_slice"]
SAMPLE += ["stream_dedup", "stream_late_counts", "stream_late_rows", "window_term_stats", "score_fixed_model", "score_fixed_requests", "fixed_run_metrics"]
SAMPLE += ["one_step_keywords", "training_lineage", "rss_scan", "api_pages_scan", "feed_config", "kpi_ranges", "region_summary", "region_geo_dashboard"]


def _rows(pdf):
    import math

    import pandas as pd

    def norm(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, float):
            return round(v, 6) + 0.0
        return v

    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con(smoke_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, smoke_dir, name):
    import __spark_entry__ as E

    got = _rows(E.queries()[name](spark, smoke_dir).toPandas())
    want = _rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
