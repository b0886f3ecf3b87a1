"""Texts are searched once where two passes or two mentions did the same work (F8, score_fixed_model)."""

import pytest
from pyspark.sql import functions as F

from topicloom.functions import dates, text
from topicloom.operators import regions
from topicloom.plans import registry as R
from topicloom.sources import dims

# every white space of the rules, and look-alikes that are none
WIDE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0    ​    ⁠　﻿᠎"
ODD = ["", " ", "  ", "a", " a", "a b", "a  b", "a \n b", "\n", "a\nb", "--", "a-b", "a - b", "a -", "- a", "é è", "x\U0001d400y", "\U0001f600 \U0001f600",
       "see www.x.example now", "http", "www", "wwwhttp://a b", "hw", "skip advertisement", "for more information!", None]
ODD += [f"a{c}b" for c in WIDE] + [f"a{c}{d}b" for c in WIDE for d in WIDE] + [f"{c} 1{c}" for c in WIDE]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(t,) for t in ODD], "t string").persist()


def _same(df, got, want):
    assert df.where(~got.eqNullSafe(want)).collect() == []


def test_blanking_and_collapsing_in_one_pass_is_the_two_rules(odd):
    for gaps, rule in ((text._TOPIC_GAPS, text.TOPIC_NONALPHA_RE), (text._DEDUP_GAPS, text.DEDUP_NONALNUM_RE)):
        two = F.regexp_replace(F.regexp_replace("t", rule, " "), text.WS_COLLAPSE_RE, " ")
        _same(odd, F.regexp_replace("t", gaps, " "), two)
    _same(odd, F.regexp_replace("t", text._WS_COLLAPSE, " "), F.regexp_replace("t", text.WS_COLLAPSE_RE, " "))
    _same(odd, F.regexp_replace("t", text._URL, " "), F.regexp_replace("t", text.URL_RE, " "))
    words = F.size(F.filter(F.split(F.regexp_replace("t", text.WS_COLLAPSE_RE, " "), " "), lambda w: w != ""))
    _same(odd, text.word_count("t"), words)


def test_every_code_point_is_blanked_as_by_the_rules(spark):
    cp = spark.range(1, 0x110000, numPartitions=8).where("id < 55296 or id > 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    t = cp.select(F.concat(F.lit("a"), char, F.lit("  b "), char).alias("t")).persist()
    for gaps, rule in ((text._TOPIC_GAPS, text.TOPIC_NONALPHA_RE), (text._DEDUP_GAPS, text.DEDUP_NONALNUM_RE)):
        _same(t, F.regexp_replace("t", gaps, " "), F.regexp_replace(F.regexp_replace("t", rule, " "), text.WS_COLLAPSE_RE, " "))
    _same(t, F.regexp_replace("t", text._WS_COLLAPSE, " "), F.regexp_replace("t", text.WS_COLLAPSE_RE, " "))
    t.unpersist()


def test_a_text_is_searched_for_regions_once(spark, odd):
    plan = odd.select(regions.region_of("t", "t").alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
    rows = dims.region_keyword_rows()
    first = {}
    for p, region, kw in rows:
        first.setdefault(kw, (p, region))
    texts = [kw for _, _, kw in rows] + [f"x {a[2]} {b[2]} y" for a, b in zip(rows, rows[7:])] + [kw + "s" for _, _, kw in rows] + [kw[:-1] for _, _, kw in rows] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, region in df.select("t", regions.region_of("t", F.lit(None).cast("string"))).collect():
        found = [x for kw, x in first.items() if f" {kw} " in f" {t or ''} "]
        assert region == (min(found)[1] if found else "World"), t


def test_dates_that_fit_no_format_are_not_tried(spark):
    times = ["01 Jan 2024 05:30:00 GMT", "Mon, 01 Jan 2024 05:30:00 GMT", "Mon, 31 Jan 2024 05:30:00 +0200", "01 Jan 2024 05:30:00 -0200", "2024-01-01T05:00:00Z",
             "2024-01-01T05:00:00+02:00", "2024-01-01t05:00:00z", "2024-01-01T05:00:00.123Z", "2024-01-01 05:00:00", "2024-01-01T05:00:00", "2024-02-30T05:00:00Z",
             "+12024-01-01T05:00:00Z", "-2024-01-01T05:00:00Z", "1 Jan 2024 05:30:00 GMT", "not a date", "", " ", "-", "2024", "12", "T", None, "  2024-01-01 05:00:00 ",
             "Tue,2024-01-01 05:00:00", "٢٠٢٤-01-01 05:00:00", "01 jan 2024 05:30:00 gmt", "01 Jan 2024 05:30:00", "99 Xyz 2024 05:30:00 GMT", "01-Jan-2024 05:30:00 GMT"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    s = F.trim(F.regexp_replace("t", r"^[A-Za-z]{3},\s*", ""))
    every = [F.try_to_timestamp(s, F.lit(f)) for f in dates.PUBLISHED_FORMATS]
    every += [F.try_to_timestamp(F.concat(s, F.lit(" +0000")), F.lit(f + " Z")) for f in dates.ZONELESS_FORMATS]
    _same(df, dates.parse_published("t"), F.coalesce(*every))
    assert df.where(dates.parse_published("t").isNotNull()).count() >= 10
    # a literal that begins with no number is settled without a parser
    plan = df.select(dates.parse_published("t").alias("at"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("gettimestamp")


def test_the_headline_is_cut_without_splitting_the_text(spark, tmp_path):
    rows = [(i + 1, t, "src1", "en") for i, t in enumerate(["a\nb\nc", "\na", "a", "", None, "a\n", "é\nb", "\n\n"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = R.articles(spark, str(tmp_path))
    assert "split_part" not in got._jdf.queryExecution().analyzed().toString()
    suffix = {1: " Read more: state-of-the-art", 2: " https://x.example/a?b=1 end", 3: " talks in Paris, gaza stall", 4: " Global markets in berlin", 5: " help us now", 6: " South Sudan peace"}
    heads = {r["ord"]: r["headline"] for r in got.collect()}
    for i, t, *_ in rows:
        if i in suffix:
            assert heads[i] == (None if t is None else t.split("\n")[0] + suffix[i])
    assert heads[7].startswith("é in ") and heads[8] == ""
