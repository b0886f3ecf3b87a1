"""Daily preprocess job (E1): raw articles -> processed articles.

One plan: null-headline drop and dedup (two shuffles), then row-local
expressions only -- cleaning, features, timestamps, region tagging -- and one
broadcast join for coordinates.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions import dates, text
from topicloom.functions.compute import with_columns_once
from topicloom.operators import dedup, regions


#: What each derived column is made of.  ``wanted`` columns and what they need are computed,
#: nothing else: the generator that keeps a filter from recomputing a text chain also
#: keeps Catalyst from dropping an unused one.
NEEDS = {
    "headline_clean": (), "description_clean": (), "region": (), "lat": ("region",), "lon": ("region",),
    "headline_length": ("headline_clean",), "headline_word_count": ("headline_clean",),
    "description_length": ("description_clean",), "description_word_count": ("description_clean",),
    "published_at_parsed": (), "publication_hour": ("published_at_parsed",), "publication_day_of_week": ("published_at_parsed",),
    "topic_text": ("headline_clean", "description_clean"),
}


def needed(wanted: Iterable[str] | None) -> set[str]:
    """The derived columns to compute for ``wanted`` (all of them for None)."""
    if wanted is None:
        return set(NEEDS)
    out: set[str] = set()
    for c in wanted:
        if c in NEEDS:
            out |= {c} | needed(NEEDS[c])
    return out


def add_clean_columns(df: DataFrame, wanted: Iterable[str] | None = None) -> DataFrame:
    need = needed(wanted)
    cols = {c: text.clean_text(src) for c, src in (("headline_clean", "headline"), ("description_clean", "description")) if c in need}
    return with_columns_once(df, cols) if cols else df


def add_features(df: DataFrame, wanted: Iterable[str] | None = None) -> DataFrame:
    """Text features, time features, region + coordinates, topic text (add_features order)."""
    need = needed(wanted)
    out = df
    for side in ("headline", "description"):
        if f"{side}_length" in need:
            out = out.withColumn(f"{side}_length", F.length(f"{side}_clean"))
        if f"{side}_word_count" in need:
            out = out.withColumn(f"{side}_word_count", text.word_count(f"{side}_clean"))
    if "published_at_parsed" in need:
        out = dates.time_features(out)
    if "region" in need:
        out = regions.tag_regions(out)
    if "topic_text" in need:
        # topic_text is filtered on later (FLT-03): keep it from being recomputed by a pushed filter
        out = with_columns_once(out, {"topic_text": text.topic_text("headline_clean", "description_clean")})
    return out


def preprocess(raw: DataFrame, order: str = "ord") -> DataFrame:
    """raw_article -> processed_article."""
    cleaned = add_clean_columns(dedup.clean_articles(raw, order))
    return add_features(cleaned)


def processed_columns(df: DataFrame) -> DataFrame:
    """Stable column order for processed tables."""
    first = [
        "ord", "ds", "headline", "description", "url", "published_at", "source_name", "source_section",
        "country", "language", "headline_clean", "description_clean", "headline_length",
        "headline_word_count", "description_length", "description_word_count", "published_at_parsed",
        "publication_hour", "publication_day_of_week", "region", "lat", "lon", "topic_text",
    ]
    present = [c for c in first if c in df.columns]
    rest = [c for c in df.columns if c not in present]
    return df.select(*present, *rest)


def with_ingestion_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_timestamp", F.current_timestamp())
