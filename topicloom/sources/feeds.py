"""Landed-source readers and normalisers (SRC-01..13, JON-05/06).

Fetching over HTTP is out of scope: feeds and API pages are files that a
collector landed.  Everything here is a DataFrame scan plus column functions;
feed attributes are a small dimension joined by broadcast.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions import dates
from topicloom.functions.html import clean_html
from topicloom.operators.dedup import key_digest
from topicloom.operators.joins import broadcast_if_small
from topicloom.operators.ranking import distributed_rank

UNKNOWN = "unknown"


def _truthy(c: Column) -> Column:
    """Python truthiness of an optional string: not NULL and not empty."""
    return c.isNotNull() & (F.length(c) > 0)


def feed_labels(feeds: DataFrame) -> DataFrame:
    """SRC-02: attribute fallbacks when a key is absent, plus the ``name/section`` label."""
    out = feeds.select(
        "feed_key",
        F.coalesce("source_name", "name", F.lit(UNKNOWN)).alias("source_name"),
        F.coalesce("source_section", "category", F.lit(UNKNOWN)).alias("source_section"),
        F.coalesce("country", F.lit(UNKNOWN)).alias("country"),
        F.coalesce("language", F.lit(UNKNOWN)).alias("language"),
        "api_section",
    )
    return out.withColumn("label", F.concat_ws("/", "source_name", "source_section"))


def join_feed(items: DataFrame, feeds: DataFrame, key: str = "feed_key") -> DataFrame:
    """JON-05: feed attributes onto items (feeds: a configuration table, broadcast after a size check)."""
    return items.join(broadcast_if_small(feed_labels(feeds).drop("label", "api_section")), key, "left")


def normalize_rss(items: DataFrame, feeds: DataFrame, strip_html: bool = True) -> DataFrame:
    """SRC-04: RSS/Atom items -> raw_article rows.

    headline = title; description = description else summary (HTML stripped,
    NULL stays NULL); published = published else updated; UTC ingestion time."""
    desc = F.coalesce(F.col("description"), F.col("summary"))
    j = join_feed(items, feeds)
    return j.select(
        *([c for c in ("ord",) if c in items.columns]),
        F.col("title").alias("headline"),
        (clean_html(desc) if strip_html else desc).alias("description"),
        F.col("link").alias("url"),
        F.coalesce(F.col("published"), F.col("updated")).alias("published_at"),
        "source_name",
        "source_section",
        "country",
        "language",
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def normalize_api(results: DataFrame, feeds: DataFrame, strip_html: bool = True) -> DataFrame:
    """SRC-06: API results -> raw_article rows.

    headline = fields.headline if truthy else webTitle; description = trailText
    if truthy else bodyText if truthy else "" (HTML stripped); country and
    language stay NULL when the feed lacks them."""
    f = F.col("fields")
    trail, body = f["trailText"], f["bodyText"]
    raw_desc = F.when(_truthy(trail), trail).when(_truthy(body), body)
    desc = F.coalesce(clean_html(raw_desc) if strip_html else raw_desc, F.lit(""))
    labels = feeds.select(
        "feed_key", "source_name", "source_section", F.col("country").alias("_country"), F.col("language").alias("_language")
    )
    j = results.join(broadcast_if_small(labels), "feed_key", "left")
    return j.select(
        *([c for c in ("ord",) if c in results.columns]),
        F.when(_truthy(f["headline"]), f["headline"]).otherwise(F.col("webTitle")).alias("headline"),
        desc.alias("description"),
        F.col("webUrl").alias("url"),
        F.col("webPublicationDate").alias("published_at"),
        "source_name",
        "source_section",
        F.col("_country").alias("country"),
        F.col("_language").alias("language"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def _text_fields(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


#: ``<link>`` holds an address in RSS and RDF; in Atom there are several, with attributes.
LINK = T.StructType(_text_fields("_VALUE", "_href", "_rel"))
#: Items of RSS 2.0 and RDF (RSS 1.0) files, and entries of Atom files, as far as they are used.
ITEM_SCHEMA = T.StructType(
    _text_fields("title", "description", "summary", "content:encoded", "content", "pubDate", "dc:date", "published", "updated", "guid", "id", "_rdf:about")
    + [T.StructField("link", T.ArrayType(LINK)), T.StructField("_corrupt_record", T.StringType())]
)


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """SRC-03: landed feed files of any of the three formats, one row an item or entry:
    (guid, title, link, description, summary, published, updated, feed_key, source_file,
    corrupt).  ``path`` holds a folder ``feed=<key>`` for each feed.

    The format shows in the item: its link is the text of ``link`` or, in Atom, the address
    of the alternate (or unmarked) ``link``; its summary falls back to the encoded content;
    a time is ``pubDate`` or ``published``, else ``dc:date`` or ``updated``.  An item that
    can't be parsed is kept, with its text in ``corrupt``; the others of its file are not
    affected."""

    def rows(tag: str) -> DataFrame:
        reader = spark.read.format("xml").option("rowTag", tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
        return reader.schema(ITEM_SCHEMA).load(path).select("*", F.col("_metadata.file_path").alias("source_file"))

    items = rows("item").unionByName(rows("entry"))  # a file has the one or the other
    own = F.filter("link", lambda x: x["_href"].isNotNull() & F.coalesce(x["_rel"] == "alternate", F.lit(True)))
    text = F.filter("link", lambda x: F.length(F.trim(x["_VALUE"])) > 0)
    link = F.coalesce(F.trim(F.try_element_at(text, F.lit(1))["_VALUE"]), F.try_element_at(own, F.lit(1))["_href"])
    col = lambda name: F.col(f"`{name}`")
    return items.select(
        F.coalesce("guid", "id", col("_rdf:about"), link).alias("guid"),
        "title",
        link.alias("link"),
        "description",
        F.coalesce("summary", col("content:encoded"), "content").alias("summary"),
        F.coalesce("pubDate", "published").alias("published"),
        F.coalesce(col("dc:date"), F.col("updated")).alias("updated"),
        F.url_decode(F.regexp_extract("source_file", "feed=([^/]+)/", 1)).alias("feed_key"),
        "source_file",
        F.col("_corrupt_record").alias("corrupt"),
    )


#: What is used of an API page; reading it needs no second pass to infer a schema.
API_RESULT = T.StructType(
    [T.StructField("ord", T.LongType()), *_text_fields("feed_key", "webTitle", "webUrl", "webPublicationDate")]
    + [T.StructField("fields", T.StructType(_text_fields("headline", "trailText", "shortUrl", "bodyText")))]
)
API_PAGE = T.StructType(
    [T.StructField("response", T.StructType([*_text_fields("status"), T.StructField("currentPage", T.LongType()), T.StructField("results", T.ArrayType(API_RESULT))]))]
)


def read_api_pages(spark: SparkSession, path: str, schema: T.StructType = API_PAGE, multi_line: bool = True) -> DataFrame:
    """SRC-05: landed API pages (one JSON document per file, or one per line).
    A page whose status is not ``ok`` fails the job, as the reference raises on it."""
    pages = spark.read.option("multiLine", multi_line).schema(schema).json(path).withColumn("source_file", F.col("_metadata.file_path"))
    checked = pages.withColumn(
        "_ok",
        F.when(F.col("response.status") == "ok", F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("API page with unexpected status: "), F.coalesce(F.col("response.status"), F.lit("NULL"))))
        ),
    )
    return checked.where("_ok").select("source_file", F.explode("response.results").alias("r")).select("source_file", "r.*")


def page_slice(df: DataFrame, section: str, ts: Column, from_date: str, to_date: str, page_size: int = 50, max_pages: int | None = None, order: str = "ord") -> DataFrame:
    """SRC-07: per section, articles in the inclusive date range, newest first,
    cut into pages of ``page_size``; optionally only the first ``max_pages``."""
    d = F.to_date(ts)
    in_range = df.where(ts.isNotNull() & (d >= F.lit(from_date).cast("date")) & (d <= F.lit(to_date).cast("date")))
    if max_pages:
        # rank <= k lets Spark keep only the top k per section on the map side
        w = Window.partitionBy(section).orderBy(ts.desc(), F.col(order))
        out = in_range.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_pages * page_size)
    else:
        # every page: rank without sorting a whole (possibly hot) section in one task
        out = distributed_rank(in_range.withColumn("_ts", ts), section, [F.col("_ts").desc(), F.col(order)]).drop("_ts")
    return out.withColumn("page", F.ceil(F.col("rank") / page_size).cast("int"))


def read_window(spark: SparkSession, path: str, start: str, end: str, ds: str = "ds") -> DataFrame:
    """SRC-09: the inclusive ``[start, end]`` day window of a ds-partitioned table
    (a partition filter: only those directories are listed and read)."""
    df = spark.read.parquet(path)
    return df.where((F.col(ds) >= F.lit(start)) & (F.col(ds) <= F.lit(end))).withColumn("source_file", F.input_file_name())


def missing_days(spark: SparkSession, present: DataFrame, start: str, end: str, ds: str = "ds") -> DataFrame:
    """JON-06: days of the window without data (expected days anti-joined with present ones)."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    have = present.select(F.col(ds).cast("date").alias("day")).distinct()
    return days.join(have, "day", "left_anti")


def union_channels(frames: list[DataFrame]) -> DataFrame:
    """SRC-10 / SET-01: bag union of channel tables with drifting schemas."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_predictions(df: DataFrame) -> DataFrame:
    """SRC-13: parse published_at (invalid -> NULL); if there is no region
    column, take country, else source_name, else ``World`` (by column presence)."""
    out = df
    if "published_at" in df.columns:
        out = out.withColumn("published_at", dates.parse_published("published_at"))
    if "region" not in df.columns:
        if "country" in df.columns:
            out = out.withColumn("region", F.col("country"))
        elif "source_name" in df.columns:
            out = out.withColumn("region", F.col("source_name"))
        else:
            out = out.withColumn("region", F.lit("World"))
    return out


def partition_values(spark: SparkSession, path: str, column: str = "ds") -> list[str]:
    """SRC-12: the values of a table's first partition column, ascending, from the names of its
    folders: one listing, no file is opened."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(unquote(n.partition("=")[2]) for n in names if n.startswith(f"{column}="))


def prediction_dates(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12: available dates, newest first (a row a day)."""
    days = [(d,) for d in reversed(partition_values(spark, path))]
    return spark.createDataFrame(days, "ds string")


def read_day(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """One day of a table partitioned by ``ds`` (the newest), with ``ds`` as text.  Only that
    day's folder is listed and read.  A day that isn't there is an error."""
    days = partition_values(spark, path)
    day = day or max(days, default=None)
    if day not in days:
        raise FileNotFoundError(f"{path} has no day {day}" if day else f"{path} has no days")
    return spark.read.option("basePath", path).parquet(f"{path}/ds={quote(day, safe='-')}").withColumn("ds", F.lit(day))


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-08: raw CSV (explicit schema, multi-line quoted text, whitespace kept)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def profile(df: DataFrame) -> DataFrame:
    """PRJ-02: per column, non-null and distinct counts (one aggregate pass), returned in long
    form ``(column, non_null, distinct)``.  Values are counted by 16-byte digests, so whole
    texts are neither copied per column nor shuffled."""
    narrow = df.select(*[F.when(F.col(c).isNotNull(), key_digest(F.col(c))).alias(c) for c in df.columns])
    aggs = []
    for c in df.columns:
        aggs += [F.count(F.col(c)).alias(f"nn_{c}"), F.count_distinct(F.col(c)).alias(f"nd_{c}")]
    wide = narrow.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"nn_{c}").alias("non_null"), F.col(f"nd_{c}").alias("distinct")) for c in df.columns]
    return wide.select(F.explode(F.array(*entries)).alias("p")).select("p.*")
