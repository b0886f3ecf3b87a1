"""Fixed dimension tables: region keywords, coordinates, topic colours, feeds.

All of them are tiny and bounded by their definition (167 regions, 465
keywords, 10 dashboard regions, 7 colours), so joins against them are
broadcast joins.  ``MAX_DIM_ROWS`` guards that promise where they are built.
"""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from topicloom.functions.fixed import TOPIC_COLORS

DATA_DIR = Path(__file__).resolve().parent.parent / "data"
MAX_DIM_ROWS = 10_000


def _lines(name: str):
    for raw in (DATA_DIR / name).read_text(encoding="utf-8").splitlines():
        line = raw.strip()
        if line and not line.startswith("#"):
            head, _, tail = line.partition(": ")
            yield head, tail


@lru_cache(maxsize=None)
def region_keyword_rows() -> tuple[tuple[int, str, str], ...]:
    """(priority, region, keyword); priority = position of the region in the dictionary."""
    rows = []
    for priority, (region, tail) in enumerate(_lines("region_keywords.txt")):
        for kw in tail.split(", "):
            rows.append((priority, region, kw))
    return tuple(rows)


@lru_cache(maxsize=None)
def region_coordinate_rows(dashboard: bool = False) -> tuple[tuple[str, float, float], ...]:
    name = "dashboard_coordinates.txt" if dashboard else "region_coordinates.txt"
    rows = []
    for region, tail in _lines(name):
        lat, lon = (float(v) for v in tail.split(", "))
        rows.append((region, lat, lon))
    return tuple(rows)


def _small(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    if len(rows) > MAX_DIM_ROWS:
        raise ValueError(f"dimension table too large to broadcast: {len(rows)} rows")
    return spark.createDataFrame(list(rows), schema)


KEYWORD_SCHEMA = T.StructType(
    [
        T.StructField("priority", T.IntegerType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("keyword", T.StringType(), False),
    ]
)
COORD_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType(), False),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lon", T.DoubleType(), False),
    ]
)


def region_keywords(spark: SparkSession) -> DataFrame:
    return _small(spark, region_keyword_rows(), KEYWORD_SCHEMA)


def regions(spark: SparkSession) -> DataFrame:
    """(priority, region) in dictionary order."""
    seen, rows = set(), []
    for p, r, _ in region_keyword_rows():
        if r not in seen:
            seen.add(r)
            rows.append((p, r))
    schema = T.StructType([KEYWORD_SCHEMA["priority"], KEYWORD_SCHEMA["region"]])
    return _small(spark, rows, schema)


def region_coordinates(spark: SparkSession, dashboard: bool = False) -> DataFrame:
    return _small(spark, region_coordinate_rows(dashboard), COORD_SCHEMA)


def topic_colors(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("color_idx", T.IntegerType(), False), T.StructField("hex", T.StringType(), False)])
    return _small(spark, list(enumerate(TOPIC_COLORS)), schema)


FEED_SCHEMA = T.StructType(
    [
        T.StructField("feed_key", T.StringType(), False),
        T.StructField("source_name", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("source_section", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("language", T.StringType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("api_section", T.StringType(), True),
    ]
)


def load_feeds(spark: SparkSession, config_path: str) -> DataFrame:
    """SRC-01: feed configuration (YAML ``sources:`` list) as a broadcastable table.

    Keys absent from a feed stay NULL so SRC-02's fallbacks can tell
    "missing" from "present"."""
    import yaml  # optional dependency, only needed for YAML configs

    text = "\n".join(r["value"] for r in spark.read.text(config_path, wholetext=True).collect())  # one file, from any store
    feeds = yaml.safe_load(text)["sources"]
    rows = []
    for i, feed in enumerate(feeds):
        rows.append(
            (
                str(feed.get("feed_key", i)),
                feed.get("source_name"),
                feed.get("name"),
                feed.get("source_section"),
                feed.get("category"),
                feed.get("country"),
                feed.get("language"),
                feed.get("url"),
                feed.get("api_section"),
            )
        )
    return _small(spark, rows, FEED_SCHEMA)
