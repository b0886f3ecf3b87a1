"""What grows with a stream: micro-batches with the landed bytes, keyed states with the buckets."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from topicloom.plans import registry
from topicloom.streaming import horizon as HZ
from topicloom.streaming import stream as ST


def test_micro_batches_follow_bytes_not_files(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.range(60, numPartitions=30).write.parquet(src)
    s = ST.read_stream(spark, src, spark.read.parquet(src).schema, max_bytes=registry.BATCH_BYTES)
    progress = [p for p in ST.run_append(s, out, ck) if p.numInputRows]
    assert len(progress) == 1
    assert sorted(r["id"] for r in spark.read.parquet(out).select("id").collect()) == list(range(60))


def test_keys_share_states(spark, tmp_path):
    """1,500 keys over three landings: a state a bucket, and each key's rows as if alone."""
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    day0 = datetime(2024, 1, 1)
    rows = [(k if k else None, d, 100 * d + k) for k in range(1500) for d in range(0, 12, 1 + k % 4)]
    df = spark.createDataFrame(rows, "key int, day int, n int")
    df = df.withColumn("ts", F.lit(day0).cast("timestamp") + F.make_interval(days=F.col("day"), secs=F.coalesce("key", F.lit(0))))
    progress = []
    with HZ.settings(spark, HZ.STATE_STORE):
        for lo in (0, 4, 8):
            df.where(F.col("day").between(lo, lo + 3)).write.mode("append").parquet(src)
            s = ST.read_stream(spark, src, spark.read.parquet(src).schema)
            progress += ST.run_append(HZ.dedup_horizon(s, ["key"], "ts", "3 days", "1 day"), out, ck)
    got = {(r["key"], r["day"], r["n"]) for r in spark.read.parquet(out).collect()}
    newest = max(day0 + timedelta(days=d, seconds=k or 0) for k, d, _ in rows)
    mark = newest - timedelta(days=1)
    want, last = set(), {}
    for k, d, n in sorted(rows, key=lambda r: r[1]):
        at = day0 + timedelta(days=d, seconds=k or 0)
        if at < mark and (k not in last or at - last[k] >= timedelta(days=3)):
            want.add((k, d, n))
            last[k] = at
    assert got == want
    for table in ("pending", "last", "armed"):
        state = spark.read.format("statestore").option("stateVarName", table).load(ck)
        assert state.select("key").distinct().count() <= HZ.BUCKETS


def test_blocks_round_trip():
    rows = [("a", 1, "x"), ("b", 2**62, None), ("", -5, "é")]
    assert HZ.unpack(HZ.pack(list(zip(*rows)), HZ._ROWS)) == rows


def test_decide_keeps_the_rule_of_one_key():
    last = {"a": 0}
    assert HZ.decide([("a", 9, "2"), ("a", 10, "3"), ("b", 1, "5"), ("b", 1, "4"), ("a", 20, "6")], last, 10) == ["3", "6", "4"]
    assert last == {"a": 20, "b": 1}
