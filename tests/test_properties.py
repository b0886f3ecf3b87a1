"""Property tests: Spark (Java regex) text rules agree with the independent
DuckDB (RE2) formulations on random Unicode strings, and dedup is stable."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from topicloom.functions import text as TX
from topicloom.plans import oracle as O

ALPHABET = st.sampled_from(
    list("abcdefghijklmnopqrstuvwxyzABCDEZ0123456789")
    + list(" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0     　")
    + list("äöüÄÖÜßéèàçÉÈÀÇñÊê'’-–.,:;!?/&()[]\"")
    + ["http://x.y/z ", "www.a.b ", " read more ", " subscribe now ", " for more information ", "Привет", "日本"]
)
TEXTS = st.lists(st.lists(ALPHABET, max_size=40).map("".join), min_size=30, max_size=60)


def _duck(strings, expr_sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, raw VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(strings)))
    return dict(con.execute(f"SELECT i, {expr_sql} FROM t").fetchall())


def _spark(spark, strings, col):
    df = spark.createDataFrame(list(enumerate(strings)), "i int, raw string")
    return {r[0]: r[1] for r in df.select("i", col).collect()}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture], derandomize=True)
@given(TEXTS)
def test_clean_text_dialects_agree(spark, strings):
    assert _spark(spark, strings, TX.clean_text("raw")) == _duck(strings, O.clean_text("raw"))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture], derandomize=True)
@given(TEXTS)
def test_dedup_key_dialects_agree(spark, strings):
    assert _spark(spark, strings, TX.dedup_key("raw")) == _duck(strings, O.dedup_key("raw"))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture], derandomize=True)
@given(TEXTS)
def test_topic_text_dialects_agree(spark, strings):
    sp = _spark(spark, strings, TX.clean_topic_text(TX.clean_text("raw")))
    tok = O.topic_tokens_from_prepared(O.topic_prepared(O.clean_text("raw")))
    dk = _duck(strings, f"array_to_string({O.ordered_distinct(tok)}, ' ')")
    assert sp == dk


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture], derandomize=True)
@given(TEXTS)
def test_word_count_and_strip(spark, strings):
    from pyspark.sql import functions as F

    sp = _spark(spark, strings, F.concat_ws("|", TX.word_count("raw").cast("string"), TX.strip_ws("raw")))
    dk = _duck(strings, f"CAST({O.word_count("raw")} AS VARCHAR) || '|' || {O.strip_ws("raw")}")
    assert sp == dk
