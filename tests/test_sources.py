"""SRC-01/02/05 and sink round trips."""

import json
import os
import tempfile

import pytest

from topicloom.sources import dims, feeds, sinks


def test_yaml_feeds_and_fallbacks(spark):
    pytest.importorskip("yaml")
    d = tempfile.mkdtemp(prefix="tl-feeds-")
    path = os.path.join(d, "sources.yaml")
    with open(path, "w") as fh:
        fh.write(
            "sources:\n"
            "  - name: Paper\n    category: World\n    url: https://a.example/rss\n"
            "  - source_name: Daily\n    source_section: Tech\n    country: UK\n    language: en\n    url: https://b.example/rss\n    api_section: technology\n"
            "  - url: https://c.example/rss\n"
        )
    f = dims.load_feeds(spark, path)
    got = {r["feed_key"]: r for r in feeds.feed_labels(f).collect()}
    assert got["0"]["label"] == "Paper/World" and got["0"]["country"] == "unknown"
    assert got["1"]["label"] == "Daily/Tech" and got["1"]["api_section"] == "technology"
    assert got["2"]["label"] == "unknown/unknown"


def _page(status, results):
    return {"response": {"status": status, "pages": 1, "results": results}}


def test_api_pages_status_check(spark):
    d = tempfile.mkdtemp(prefix="tl-api-")
    res = [{"webTitle": "T", "webUrl": "u", "webPublicationDate": "2024-01-01T00:00:00Z", "fields": {"headline": "H", "trailText": "<p>x &amp; y</p>"}}]
    with open(os.path.join(d, "p1.json"), "w") as fh:
        json.dump(_page("ok", res), fh)
    rows = feeds.read_api_pages(spark, d).collect()
    assert len(rows) == 1 and rows[0]["fields"]["headline"] == "H"
    with open(os.path.join(d, "p2.json"), "w") as fh:
        json.dump(_page("error", res), fh)
    with pytest.raises(Exception):
        feeds.read_api_pages(spark, d).collect()


def test_partitioned_sink_skips_empty_and_overwrites_one_day(spark):
    d = tempfile.mkdtemp(prefix="tl-sink-") + "/t"
    a = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "x int, ds string")
    assert sinks.write_partitioned(a, d, ["ds"])
    assert not sinks.write_partitioned(a.limit(0), d, ["ds"])
    b = spark.createDataFrame([(3, "2024-01-02")], "x int, ds string")
    sinks.write_partitioned(b, d, ["ds"])
    assert sorted(r["x"] for r in spark.read.parquet(d).collect()) == [1, 3]
