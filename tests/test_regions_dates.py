"""JON-01..03, SCL-11..13 and SCL-16 rules (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from topicloom.functions import dates
from topicloom.operators import regions, report

REGION_CASES = [
    ("Gaza talks stall in Paris, France", "France"),
    ("Help us now", "United States"),
    ("Global markets in Berlin", "World"),
    ("BERLIN: strike", "World"),
    ("New  York rain", "World"),
    ("South Sudan peace", "Sudan"),
    ("U.S. economy", "United States"),
    ("European Union summit", "Europe"),
    ("Brussels and EU talks", "European Union"),
    ("Jordan Peterson in London", "United Kingdom"),
    ("x south africa y", "Africa"),
    ("nothing to see", "World"),
]


def test_region_rules(spark):
    df = spark.createDataFrame(REGION_CASES, "headline string, expected string").withColumn("description", F.lit(""))
    got = regions.tag_regions(df).select("headline", "expected", "region", "lat", "lon").collect()
    for r in got:
        assert r["region"] == r["expected"], r["headline"]
    world = [r for r in got if r["region"] == "World"][0]
    assert (world["lat"], world["lon"]) == (0.0, 0.0)


def test_region_uses_description(spark):
    df = spark.createDataFrame([("Headline", "meeting in tokyo today")], "headline string, description string")
    assert regions.tag_regions(df).first()["region"] == "Japan"


def test_dashboard_coordinates_overwrite(spark):
    df = spark.createDataFrame([("Africa", 1.0, 1.0), (None, 1.0, 1.0), ("Peru", 1.0, 1.0)], "region string, lat double, lon double")
    got = {r["region"]: (r["lat"], r["lon"]) for r in regions.add_coordinates(df, dashboard=True).collect()}
    assert got["Africa"] == (-8.7832, 34.5085)
    assert got["World"] == (20.0, 0.0)
    assert got["Peru"] == (20.0, 0.0)


def test_banner_dates(spark):
    df = spark.createDataFrame([("2026-05-12",), ("2026-10-03",), ("xx",)], "d string")
    assert [r[0] for r in df.select(dates.banner_date("d")).collect()] == ["12.MAI.2026", "03.OKT.2026", "xx"]


def test_published_formats(spark):
    rows = [
        ("2024-01-05T10:00:00Z", "2024-01-05 10:00:00"),
        ("Mon, 05 Jan 2024 10:30:00 GMT", "2024-01-05 10:30:00"),
        ("Mon, 05 Jan 2024 10:30:00 +0200", "2024-01-05 08:30:00"),
        ("not a date", None),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "s string, e string")
    out = df.select("e", F.date_format(dates.parse_published("s"), "yyyy-MM-dd HH:mm:ss").alias("g")).collect()
    assert [r["g"] for r in out] == [r["e"] for r in out]
    hours = df.select(dates.publication_hour(dates.parse_published("s"))).collect()
    assert [h[0] for h in hours] == [10, 10, 8, None, None]


def test_map_intensity(spark):
    df = spark.createDataFrame([("A", 0.0, 0.0, "h")] + [("B", 1.0, 1.0, "h")] * 4, "region string, lat double, lon double, headline string").withColumn("ord", F.monotonically_increasing_id())
    got = {r["region"]: r["intensity"] for r in report.region_counts(df, with_topic=False).collect()}
    assert got == {"A": 213, "B": 255}


def test_topic_color(spark):
    df = spark.createDataFrame([(0,), (3,), (8,), (None,)], "topic_id int")
    got = df.select(report.topic_rgb(F.col("topic_id")).alias("c")).collect()
    assert [list(r["c"]) for r in got] == [[213, 238, 242], [239, 100, 173], [174, 187, 208], [239, 245, 90]]


@pytest.mark.parametrize("search,expected", [("IN", 2), ("", 3), ("zzz", 0)])
def test_headline_search(spark, search, expected):
    df = spark.createDataFrame([("Rain in Paris",), ("WIN big",), (None,)], "headline string")
    assert report.filter_facets(df, search=search).count() == expected


def test_time_features_ignore_session_zone(spark):
    rows = [("Mon, 05 Jan 2024 23:30:00 GMT",), ("2024-01-05T10:00:00Z",), ("2024-01-05 22:15:00",)]
    df = spark.createDataFrame(rows, "s string")
    cols = [F.unix_timestamp(dates.parse_published("s")), dates.publication_hour(dates.parse_published("s")), dates.publication_day_of_week(dates.parse_published("s"))]
    utc = [tuple(r) for r in df.select(*cols).collect()]
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = [tuple(r) for r in df.select(*cols).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert other == utc
    assert [u[1] for u in utc] == [23, 10, 22] and utc[0][2] == "Friday"


def test_event_time_ignores_session_zone(spark):
    from topicloom.streaming.stream import event_time

    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-05 23:30:00' AS ts")
    want = 1704497400  # 2024-01-05T23:30:00Z
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(F.unix_timestamp(event_time("ts"))).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
