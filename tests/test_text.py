"""SCL-01/02/03/05, DDP-06 against the edge rows of FIXTURES.md section 4."""

import pytest
from pyspark.sql import functions as F

from topicloom.functions import text as TX

EDGE = [
    ("U.S. - don't go: https://x.y/z now", "us  dont go now", 15, 4, "dont now", "u s don t go now"),
    ("a – b", "a  b", 4, 2, "", "a b"),
    ("Señor Ê ça", "seor  ça", 8, 2, "seor", "se or a"),
    ("Read more: visit www.x.y/z today", "read more visit today", 21, 4, "visit", "read more visit today"),
    (
        "München 2026: Read – more news, people people",
        "münchen 2026 read  more news people people",
        42,
        7,
        "nchen",
        "m nchen 2026 read more news people people",
    ),
    ("Continue reading... full story", "continue reading full story", 27, 4, "", "continue reading full story"),
    ("Привет мир", "", 0, 0, "", ""),
    ("state-of-the-art", "stateoftheart", 13, 1, "stateoftheart", "state of the art"),
    ("a b", "a b", 3, 2, "", "a b"),
    (None, "", 0, 0, "", ""),
]


@pytest.fixture(scope="module")
def edge_rows(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(EDGE)], "i int, raw string")
    out = df.select(
        "i",
        TX.clean_text("raw").alias("clean"),
        TX.dedup_key("raw").alias("key"),
    ).withColumn("topic", TX.topic_text("clean", F.lit(""))).withColumn("len", F.length("clean")).withColumn("words", TX.word_count("clean"))
    return {r["i"]: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(EDGE)))
def test_clean_text(edge_rows, i):
    r = edge_rows[i]
    assert r["clean"] == EDGE[i][1]
    assert (r["len"], r["words"]) == (EDGE[i][2], EDGE[i][3])


@pytest.mark.parametrize("i", range(len(EDGE)))
def test_topic_text(edge_rows, i):
    assert edge_rows[i]["topic"] == EDGE[i][4]


@pytest.mark.parametrize("i", range(len(EDGE)))
def test_dedup_key(edge_rows, i):
    assert edge_rows[i]["key"] == EDGE[i][5]


def test_dedup_key_idempotent(edge_rows, spark):
    keys = [r["key"] for r in edge_rows.values()]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(TX.dedup_key("k")).collect()] == keys


def test_boilerplate_phrases_removed(spark):
    df = spark.createDataFrame([("subscribe now follow live this story has been updated for more information rocket",)], "t string")
    assert df.select(TX.clean_topic_text("t")).first()[0] == "rocket"


def test_token_dedup_keeps_first_occurrence(spark):
    df = spark.createDataFrame([("b a b c a",)], "t string")
    assert df.select(TX.dedup_tokens("t")).first()[0] == "b a c"
