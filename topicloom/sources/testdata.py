"""Readers for the benchmark tables and the ``articles`` adapter.

The benchmark ``documents`` table has free text but none of the fields a news
feed has.  ``articles`` derives a raw-article table from it -- the whole text
is kept: the first line is the headline, everything after it the description --
and injects what the pipeline rules need to see (missing and blank urls,
repeated urls, URLs and boilerplate, region keywords, mixed date formats).
The same derivation is written in SQL in ``topicloom.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.sources import dims

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Headline suffix by doc_id % 12 (fixture variety: region keywords, boilerplate, URLs); where it
# is 7, the keywords of all regions in turn.
HEADLINE_SUFFIXES = {
    0: " in france now",
    1: " Read more: state-of-the-art",
    2: " https://x.example/a?b=1 end",
    3: " talks in Paris, gaza stall",
    4: " Global markets in berlin",
    5: " help us now",
    6: " South Sudan peace",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles (raw_article schema + ``ord`` and ``ds``) derived from ``documents``."""
    d = table(spark, sf_dir, "documents")
    doc_id, text = F.col("doc_id"), F.col("text")
    nl = F.instr(text, "\n")
    keywords = [kw for _, _, kw in dims.region_keyword_rows()]
    nth = F.floor(doc_id / 12).cast("int") % len(keywords) + 1
    keyword = F.element_at(F.split(F.lit("|".join(keywords)), r"\|"), nth)
    suffix = F.when(doc_id % 12 == 7, F.concat(F.lit(" in "), keyword, F.lit(" today"))).otherwise("")
    for k in sorted(HEADLINE_SUFFIXES, reverse=True):
        suffix = F.when(doc_id % 12 == k, F.lit(HEADLINE_SUFFIXES[k])).otherwise(suffix)
    day = _pad2(doc_id % 28 + 1)
    hour = _pad2(doc_id % 24)
    published = (
        F.when(doc_id % 5 == 0, F.concat(F.lit("2024-01-"), day, F.lit("T"), hour, F.lit(":00:00Z")))
        .when(doc_id % 5 == 1, F.concat(F.lit("Mon, "), day, F.lit(" Jan 2024 "), hour, F.lit(":30:00 GMT")))
        .when(doc_id % 5 == 2, F.concat(F.lit("Mon, "), day, F.lit(" Jan 2024 "), hour, F.lit(":30:00 +0200")))
        .when(doc_id % 5 == 3, F.lit("not a date"))
    )
    country = (
        F.when(F.col("lang") == "de", "Germany")
        .when(F.col("lang") == "fr", "France")
        .when(F.col("lang") == "es", "Spain")
        .otherwise("United Kingdom")
    )
    return d.select(
        doc_id.alias("ord"),
        F.when(doc_id % 41 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.substring_index(text, "\n", 1), suffix))  # split_part splits the whole text
        .alias("headline"),
        F.when(nl > 0, F.expr("substr(text, instr(text, char(10)) + 1)")).alias("description"),
        F.when(doc_id % 10 == 0, F.lit(None).cast("string"))
        .when(doc_id % 10 == 1, F.lit("  "))
        .otherwise(F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), (doc_id % 700).cast("string")))
        .alias("url"),
        published.alias("published_at"),
        F.col("source").alias("source_name"),
        F.concat(F.lit("section"), (doc_id % 6).cast("string")).alias("source_section"),
        country.alias("country"),
        F.col("lang").alias("language"),
        F.concat(F.lit("2024-01-"), day).alias("ds"),
    )


# Days of event time that land together; every 17th event lands one batch later than its
# day, every 29th two.
ARRIVAL_DAYS = 10


def event_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``arrival``, the number of the landing each row comes with."""
    e = table(spark, sf_dir, "events")
    first = F.to_date(F.lit("2024-01-01"))
    late = F.when(F.col("event_id") % 29 == 0, 2).when(F.col("event_id") % 17 == 0, 1).otherwise(0)
    return e.withColumn("arrival", F.floor(F.datediff("ts", first) / ARRIVAL_DAYS).cast("int") + late)


def land_in_turn(df: DataFrame, path: str, turn: str, run) -> list:
    """Append the rows of each ``turn`` to ``path`` and call ``run()`` after each: what a
    collector and an incremental job do in turn.  The runs' results in one list."""
    out = []
    for n in sorted(r[0] for r in df.select(turn).distinct().collect()):  # a few landings
        df.where(F.col(turn) == n).drop(turn).write.mode("append").parquet(path)
        out.extend(run())
    return out


# ---------------------------------------------------------------- derived landed sources
# Feeds, RSS items and API results derived from ``documents`` (the same rules
# are written in SQL in ``topicloom.plans.oracle``).  Some attributes are left
# out on purpose so the fallbacks are exercised.


def _n(source: Column) -> Column:
    return F.substring(source, 4, 10).cast("int")


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source").distinct()
    n = _n(F.col("source"))
    return d.select(
        F.col("source").alias("feed_key"),
        F.when(n % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("Feed "), n.cast("string"))).alias("source_name"),
        F.when(n % 8 == 0, F.lit(None)).otherwise(F.concat(F.lit("name"), n.cast("string"))).alias("name"),
        F.when(n % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("section"), (n % 3).cast("string"))).alias("source_section"),
        F.when(n % 6 == 0, F.lit(None)).otherwise(F.concat(F.lit("category"), (n % 2).cast("string"))).alias("category"),
        F.when(n % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("country"), (n % 5).cast("string"))).alias("country"),
        F.when(n % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("lang"), (n % 7).cast("string"))).alias("language"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/rss")).alias("url"),
        F.concat(F.lit("api"), n.cast("string")).alias("api_section"),
    )


def rss_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the whole text: its first line is the title, the rest the description
    or, in every fourth item, the summary."""
    d = table(spark, sf_dir, "documents")
    doc_id, text = F.col("doc_id"), F.col("text")
    rest = F.when(F.instr(text, "\n") > 0, F.expr("substr(text, instr(text, char(10)) + 1)"))
    return d.select(
        doc_id.alias("ord"),
        F.col("source").alias("feed_key"),
        F.split_part(text, F.lit("\n"), F.lit(1)).alias("title"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), doc_id.cast("string")).alias("link"),
        F.when(doc_id % 4 == 0, F.lit(None).cast("string")).otherwise(rest).alias("description"),
        F.when(doc_id % 4 == 0, rest).alias("summary"),
        F.when(doc_id % 9 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("2024-01-"), _pad2(doc_id % 28 + 1), F.lit("T06:00:00Z")))
        .alias("published"),
        F.lit("2024-02-01T00:00:00Z").alias("updated"),
    )


def api_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with the whole text: the first line is the title (and the headline, where that
    is not left out), the rest the body and, in about half of them, the trail text."""
    d = table(spark, sf_dir, "documents")
    doc_id, text = F.col("doc_id"), F.col("text")
    first = F.split_part(text, F.lit("\n"), F.lit(1))
    rest = F.when(F.instr(text, "\n") > 0, F.expr("substr(text, instr(text, char(10)) + 1)"))
    fields = F.struct(
        F.when(doc_id % 7 == 0, F.lit("")).when(doc_id % 11 == 0, F.lit(None).cast("string")).otherwise(first).alias("headline"),
        F.when(doc_id % 3 == 0, F.lit("")).when(doc_id % 5 == 0, F.lit(None).cast("string")).otherwise(rest).alias("trailText"),
        F.concat(F.lit("https://s.example/"), doc_id.cast("string")).alias("shortUrl"),
        rest.alias("bodyText"),
    )
    return d.select(
        doc_id.alias("ord"),
        F.col("source").alias("feed_key"),
        F.concat(first, F.lit(" - "), F.col("source")).alias("webTitle"),
        F.concat(F.lit("https://api.example/"), F.col("source"), F.lit("/"), doc_id.cast("string")).alias("webUrl"),
        F.concat(F.lit("2024-01-"), _pad2(doc_id % 28 + 1), F.lit("T"), _pad2(doc_id % 24), F.lit(":15:00Z")).alias("webPublicationDate"),
        fields.alias("fields"),
    )
