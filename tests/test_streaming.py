"""STR-01 / STR-02: streams equal their batch twins; the dedup horizon holds across micro-batches."""

import datetime as dt

from topicloom.plans import preprocess as P
from topicloom.plans import registry as R
from topicloom.sources.testdata import articles
from topicloom.streaming import stream as ST


def test_stream_preprocess_equals_batch(spark, smoke_dir):
    streamed = R.QUERIES["stream_preprocess"](spark, smoke_dir).select("ord", "region", "topic_text", "headline_clean")
    base = articles(spark, smoke_dir).dropna(subset=["headline"]).fillna({"description": ""})
    batch = P.add_features(P.add_clean_columns(base)).select("ord", "region", "topic_text", "headline_clean")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_dedup_horizon_across_batches(spark):
    src = ST.scratch(spark, "dedup-src")
    t0 = dt.datetime(2024, 1, 10, 12, 0, 0)
    batches = [
        [("k1", t0), ("k2", t0)],
        [("k1", t0 + dt.timedelta(hours=5)), ("k3", t0 + dt.timedelta(days=9))],
        [("k1", t0 + dt.timedelta(days=9, hours=1))],  # far beyond the 3-day horizon of the first k1
    ]
    out, ck = ST.scratch(spark, "dedup-out"), ST.scratch(spark, "dedup-ck")
    schema = "key string, ts timestamp"
    for rows in batches:
        # a new landed file, then an incremental availableNow run on the same checkpoint
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        s = ST.read_stream(spark, src, spark.read.parquet(src).schema)
        ST.run_append(ST.dedup_within(s, ["key"], "ts", "3 days"), out, ck)
    got = sorted((r["key"], r["ts"]) for r in spark.read.parquet(out).collect())
    assert ("k1", t0) in got and ("k2", t0) in got and ("k3", t0 + dt.timedelta(days=9)) in got
    assert ("k1", t0 + dt.timedelta(hours=5)) not in got  # repeat within the horizon
    assert ("k1", t0 + dt.timedelta(days=9, hours=1)) in got  # kept: the first k1 expired with the watermark


def test_event_queries_read_a_directory_of_part_files(spark, tmp_path):
    """A table stored as part files streams like a single file."""
    import os

    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    os.symlink(f"{sf}/documents.parquet", tmp_path / "documents.parquet")
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(f"file://{tmp_path}/events.parquet")
    for name in ("stream_window_counts", "stream_dedup"):
        one, many = (sorted(map(str, E.queries()[name](spark, d).collect())) for d in (sf, str(tmp_path)))
        assert one and one == many


def test_split_takes_large_ids(spark):
    from topicloom.operators.classify import stratified_split

    d = spark.range(4_000_000_000, 4_000_000_200).selectExpr("id", "cast(id % 2 as string) as y")
    got = {r["split"]: r["count"] for r in stratified_split(d, "y", "id").groupBy("split").count().collect()}
    assert got == {"train": 160, "test": 40}
