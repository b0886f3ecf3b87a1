"""DDP-01..05: keep-first semantics and independence from partitioning."""

from pyspark.sql import functions as F

from topicloom.operators import dedup


def test_url_then_headline_pass(spark):
    rows = [(0, "A", None), (1, "A", "u"), (2, "B", "u")]
    df = spark.createDataFrame(rows, "ord long, headline string, url string").withColumn("description", F.lit(""))
    got = [(r["ord"], r["headline"], r["url"]) for r in dedup.drop_article_duplicates(df).collect()]
    assert got == [(1, "A", "u")]


def test_blank_urls_do_not_collapse(spark):
    rows = [(0, "x", "  "), (1, "y", None), (2, "z", "")]
    df = spark.createDataFrame(rows, "ord long, headline string, url string")
    assert dedup.drop_article_duplicates(df).count() == 3


def test_exact_dedup_null_equals_null(spark):
    rows = [(0, "A", None), (1, "A", None), (2, None, None), (3, None, None)]
    df = spark.createDataFrame(rows, "ord long, headline string, url string")
    assert sorted(r["ord"] for r in dedup.drop_exact_duplicates(df).collect()) == [0, 2]


def test_dedup_independent_of_partitioning(spark, smoke_dir):
    from topicloom.sources.testdata import articles

    a = articles(spark, smoke_dir).dropna(subset=["headline"])
    one = {r["ord"] for r in dedup.drop_article_duplicates(a.repartition(1)).select("ord").collect()}
    many = {r["ord"] for r in dedup.drop_article_duplicates(a.repartition(17)).select("ord").collect()}
    assert one == many
    assert one <= {r["ord"] for r in a.select("ord").collect()}


def test_hot_key_keeps_first(spark):
    # one normalised headline shared by most rows (the skew case)
    rows = [(i, "!!!" if i % 3 else f"h{i}", f"u{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "ord long, headline string, url string").repartition(13)
    out = dedup.drop_article_duplicates(df)
    hot = [r["ord"] for r in out.where("headline = '!!!'").collect()]
    assert hot == [1]


def test_stats(spark):
    a = spark.createDataFrame([(0, "a", "u"), (1, "a", "u")], "ord long, headline string, url string")
    r = dedup.dedup_stats(a, dedup.drop_article_duplicates(a)).first()
    assert (r["rows_before"], r["rows_after"], r["removed"]) == (2, 1, 1)


def test_distributed_rank_matches_window(spark):
    from pyspark.sql import Window

    from topicloom.operators.ranking import distributed_rank

    rows = [(i, "hot" if i % 3 else f"g{i % 5}", (i * 7919) % 1000) for i in range(2000)]
    df = spark.createDataFrame(rows, "ord long, g string, v long").repartition(7)
    got = {(r["ord"], r["rank"]) for r in distributed_rank(df, "g", [F.col("v").desc(), F.col("ord")]).collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("ord"))
    want = {(r["ord"], r["rank"]) for r in df.withColumn("rank", F.row_number().over(w)).collect()}
    assert got == want
