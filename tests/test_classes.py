"""The character classes as Spark runs them: exactly the sets they stand for, quick to search."""

import re

from pyspark.sql import functions as F

from topicloom.functions import text
from topicloom.operators import tfidf


def _differ(spark, pairs):
    """How many code points one pattern of each pair finds and the other doesn't."""
    cp = spark.range(1, 0x110000, numPartitions=8).where("id < 55296 or id > 57343")
    char = F.substring(F.decode(F.unhex(F.concat(F.lit("00000078"), F.lpad(F.hex("id"), 8, "0"))), "UTF-32"), 2, 1)
    found = cp.select(char.alias("c")).select(*[(F.col("c").rlike(p) != F.col("c").rlike(q)).cast("int").alias(f"p{i}") for i, (p, q) in enumerate(pairs)])
    return list(found.agg(*[F.sum(c) for c in found.columns]).first())


def test_classes_are_the_sets_of_the_rules(spark):
    pairs = [
        (rf"^[{text._WS}]$", rf"^[{text.WS}]$"),
        (text._CLEAN_DROP, text.CLEAN_DROP_RE),
        (text._TOPIC_NONALPHA, text.TOPIC_NONALPHA_RE),
        (text._DEDUP_NONALNUM, text.DEDUP_NONALNUM_RE),
        (tfidf._RUNS[tfidf.TOKEN_PATTERN].replace("{2,}", ""), r"(?U)\w"),
    ]
    assert _differ(spark, [(f"(?s){p}", f"(?s){q}") for p, q in pairs]) == [0] * len(pairs)


def test_tokens_are_those_of_the_pattern(spark):
    odd = "a ab abc_d é éé ñandú x́y ́z ́́ 日本 9 99 a‍b ½ 𝐀𝐁  ab cd\tz\nzz ab-cd a'b"
    df = spark.createDataFrame([(odd,), ("",), (" ",)], "t string")
    a, b = (F.regexp_extract_all("t", F.lit(p), 0) for p in (tfidf._RUNS[tfidf.TOKEN_PATTERN], tfidf.TOKEN_PATTERN))
    assert [r[0] for r in df.select(a).collect()] == [r[0] for r in df.select(b).collect()]


def test_cleaning_searches_no_chain_of_ranges():
    """Java takes a listed Latin-1 character from a table, and tries ranges in turn."""
    for p in (text._WS, text._CLEAN_DROP, text._TOPIC_NONALPHA, text._DEDUP_NONALNUM):
        assert not re.search(r"a-z|0-9|\\x\{1c\}-", p)
