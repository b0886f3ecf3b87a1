"""ML-07/08/11/12, SCL-04, STR-03 and the driver contract."""

import numpy as np
from pyspark.sql import functions as F

from topicloom.functions.html import html_to_text
from topicloom.operators import classify as CL
from topicloom.operators import kmeans as KM


def test_html_to_text():
    raw = "<html><head><style>p{}</style><script>var x=1;</script></head><body><!-- c --><p>Hello &amp; <b>bye</b></p> <div> x &lt; y </div></body></html>"
    assert html_to_text(raw) == "Hello & bye x < y"
    assert html_to_text(None) is None
    assert html_to_text("") == ""
    assert html_to_text("x<5 and y") == "x<5 and y"
    assert html_to_text("a<!-- note -->b") == "a b"
    assert html_to_text("<p>a<![CDATA[ b ]]>c</p>") == "a b c"
    assert html_to_text("<template>a<![CDATA[ b ]]></template>c") == "c"


def test_kmeans_assign_and_confidence(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [10.0, 0.0])], "id int, v array<double>")
    C = np.array([[0.0, 0.0], [10.0, 0.0]])
    got = {r["id"]: (r["cluster_id"], r["distance"], r["cluster_score"]) for r in KM.assign(df, "v", C).collect()}
    assert got[1] == (0, 0.0, 1.0)
    assert got[2][0] == 0 and abs(got[2][1] - 5.0) < 1e-12 and abs(got[2][2] - 0.0) < 1e-12
    assert got[3] == (1, 0.0, 1.0)


def test_stratified_split_shares(spark):
    rows = [(i, 0) for i in range(50)] + [(100 + i, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, y int")
    s = CL.stratified_split(df, "y", "doc_id").groupBy("y", "split").count().collect()
    got = {(r["y"], r["split"]): r["count"] for r in s}
    assert got == {(0, "test"): 10, (0, "train"): 40, (1, "test"): 2, (1, "train"): 8}


def test_report(spark):
    rows = [(1, 1), (1, 1), (1, 0), (0, 0), (0, 1)]
    df = spark.createDataFrame(rows, "y int, p int")
    r = {x["label"]: x for x in CL.report(df, "y", "p").collect()}
    assert abs(r["1"]["precision"] - 2 / 3) < 1e-12 and abs(r["1"]["recall"] - 2 / 3) < 1e-12
    assert abs(r["0"]["precision"] - 0.5) < 1e-12 and abs(r["0"]["recall"] - 0.5) < 1e-12
    assert abs(r["accuracy"]["f1"] - 0.6) < 1e-12
    assert r["macro avg"]["support"] == 5


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    w = {r["y"]: r["weight"] for r in CL.class_weights(df, "y").collect()}
    assert abs(w[0] - 8 / 12) < 1e-12 and abs(w[1] - 2.0) < 1e-12


def test_stream_equals_batch(spark, smoke_dir):
    from topicloom.plans import registry as R

    streamed = {tuple(r) for r in R.QUERIES["stream_window_counts"](spark, smoke_dir).collect()}
    ev = spark.read.parquet(f"{smoke_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = ev.groupBy(F.window("ts", "3 days", "1 day").alias("w"), "event_type").count()
    batch = {
        (r[0], r[1], r[2], r[3])
        for r in batch.select(F.unix_timestamp("w.start"), F.unix_timestamp("w.end"), "event_type", "count").collect()
    }
    assert streamed == batch


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_scoring_reproduces_training_assignments(spark, smoke_dir):
    from topicloom.plans import registry as R
    from topicloom.plans import train as TR

    model, X = TR.fit_topics(R.training_docs(spark, smoke_dir))
    assigned = {r["doc_id"]: r["topic_id"] for r in TR.assign(model, X).collect()}
    docs = R.training_docs(spark, smoke_dir).select("doc_id", "topic_text")
    rescored = {r["doc_id"]: r["topic_id"] for r in TR.assign(model, model.vectors(docs)).collect()}
    assert rescored == assigned
    summary = __import__("topicloom.operators.report", fromlist=["x"]).topic_summary(
        TR.assign(model, X).withColumn("ord", F.col("doc_id"))
    ).collect()
    assert sum(r["count"] for r in summary) == model.n_docs
    assert abs(sum(r["importance"] for r in summary) - 1.0) < 1e-9
    kw = model.keywords.collect()
    assert len(kw) == model.H.shape[0] and all(len(r["keywords"]) == 8 for r in kw)


def test_classifier_after_observation(spark, smoke_dir):
    """A session that used Observation metrics can still score with the classifier."""
    from pyspark.sql import Observation

    from topicloom.plans import registry as R

    o = Observation("probe")
    spark.range(5).observe(o, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert o.get["n"] == 5
    pred = R.QUERIES["text_classifier"](spark, smoke_dir).collect()
    assert len(pred) > 0 and {r["prediction"] for r in pred} <= {0, 1}
