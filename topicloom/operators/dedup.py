"""Keep-first deduplication (DDP-01..05).

"Keep first" needs an order, so every table carries ``ord`` (source order).  A frame
read from files is given the place of each row in its file (``with_file_row``); then

1. survivors are chosen on narrow rows -- a 16-byte digest of the key, the order and
   the row's place.  ``row_number() = 1`` leaves one row a key in every map partition
   before the shuffle (a hot key, say a third of all rows under one normalised
   headline, never meets in one task), and texts take no part;
2. the chosen places are written, and the rows are semi-joined with them once, with a
   broadcast if they are few.

Two rows are only the same row if they lie at the same place, so channels whose
``ord`` overlap lose nothing.  Equal orders are settled by the place.

Frames without places go through ``min_by(struct(row), ord)`` by key: one pass, but
with whole rows in the aggregation.  Null keys group together (pandas treats NaN == NaN
in ``drop_duplicates``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.functions.text import dedup_key, strip_ws
from topicloom.operators.joins import broadcast_if_small
from topicloom.session import land

#: File (hash of its path) and row in it.
PLACE = ["_file", "_row"]
#: Places that are broadcast: 16 bytes each.
MAX_PLACES = 1_000_000


def with_file_row(df: DataFrame) -> DataFrame:
    """``df`` with the place of each row in its file.  ``df`` reads files and holds each of
    their rows at most once: projections and filters, no join that repeats rows."""
    return df.select("*", F.xxhash64("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1]))


def has_places(df: DataFrame) -> bool:
    return set(PLACE) <= set(df.columns)


def key_digest(*cols: Column) -> Column:
    """16 bytes that stand for the values (null is one), whatever their lengths."""
    text = [c.cast("string") for c in cols]
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in text]
    return F.unhex(F.md5(F.concat(*parts)))


def _firsts(narrow: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order, *PLACE)
    return narrow.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def _landed_places(chosen: DataFrame) -> DataFrame:
    return broadcast_if_small(land(chosen.select(*PLACE), "dedup-places"), MAX_PLACES)


def at_places(df: DataFrame, places: DataFrame, keep_places: bool = False) -> DataFrame:
    """The rows of ``df`` (with places) that lie at ``places``."""
    out = df.join(places, PLACE, "left_semi").select(*df.columns)
    return out if keep_places else out.drop(*PLACE)


def _at_places(df: DataFrame, chosen: DataFrame, keep_places: bool) -> DataFrame:
    return at_places(df, _landed_places(chosen), keep_places)


def training_places(df: DataFrame, order: str = "ord") -> DataFrame:
    """DDP-02 on articles with places: the places of the first row per (headline, url).  Only
    these columns are read, so it comes before the texts are cleaned, not after."""
    narrow = df.select(*PLACE, key_digest(F.col("headline"), F.col("url")).alias("_k"), F.col(order).alias("_ord"))
    return _landed_places(_firsts(narrow, ["_k"], ["_ord"]))


def keep_first(df: DataFrame, keys: list[str] | list[Column], order: Column | str = "ord", keep_places: bool = False) -> DataFrame:
    """One row per key: the row with the smallest ``order`` value."""
    order_col = F.col(order) if isinstance(order, str) else order
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    if has_places(df):
        narrow = df.select(*PLACE, key_digest(*key_cols).alias("_k"), order_col.alias("_ord"))
        return _at_places(df, _firsts(narrow, ["_k"], ["_ord"]), keep_places)
    cols = df.columns
    key_names = [f"_k{i}" for i in range(len(key_cols))]
    keyed = df.select(*[k.alias(n) for k, n in zip(key_cols, key_names)], order_col.alias("_ord"), F.struct(*cols).alias("_row"))
    return keyed.groupBy(*key_names).agg(F.min_by("_row", "_ord").alias("_row")).select("_row.*")


def drop_exact_duplicates(df: DataFrame, order: str = "ord") -> DataFrame:
    """DDP-01: keep first per (headline, url); no-op when either column is missing."""
    if not {"headline", "url"}.issubset(df.columns):
        return df
    return keep_first(df, ["headline", "url"], order)


def drop_training_duplicates(df: DataFrame, order: str = "ord") -> DataFrame:
    """DDP-02: (headline, url) when both exist, else headline alone."""
    if {"headline", "url"}.issubset(df.columns):
        return keep_first(df, ["headline", "url"], order)
    if "headline" in df.columns:
        return keep_first(df, ["headline"], order)
    return df


def drop_article_duplicates(df: DataFrame, order: str = "ord", scope: list[str] | None = None, keep_places: bool = False) -> DataFrame:
    """DDP-03 then DDP-04 (``scope``: extra key columns, e.g. the source file, so
    each file is deduplicated on its own as in the whole-history rescan).

    1. rows with a (stripped, non-empty) url keep the first row per url; rows
       without a url all stay and rank after every row with a url;
    2. then one row per normalised headline, first in that new order.
    Two shuffles in total (url key, headline key)."""
    url = F.col("url").cast("string") if "url" in df.columns else F.lit(None).cast("string")
    url = strip_ws(F.coalesce(url, F.lit("")))
    no_url = F.length(url) == 0
    scoped = [F.col(c) for c in scope or []]
    if has_places(df):
        own = key_digest(F.lit("row"), *[F.col(c) for c in PLACE])  # a row without a url is a group of its own
        narrow = df.select(
            *PLACE, F.when(no_url, 1).otherwise(0).alias("_late"), F.col(order).alias("_ord"),
            F.when(no_url, own).otherwise(key_digest(F.lit("url"), *scoped, url)).alias("_u"),
            key_digest(*scoped, dedup_key("headline")).alias("_h"),
        )
        by_url = _firsts(narrow, ["_u"], ["_ord"])
        return _at_places(df, _firsts(by_url, ["_h"], ["_late", "_ord"]), keep_places)
    keyed = df.withColumns({"_url_key": url, "_late": F.when(no_url, 1).otherwise(0), "_own": F.monotonically_increasing_id()})
    own = F.when(F.col("_late") == 1, F.col("_own"))
    stage = keep_first(keyed, [*scoped, F.col("_url_key"), own], order).withColumn("_hkey", dedup_key("headline"))
    rank = F.struct("_late", order, "_own")
    return keep_first(stage, [*scoped, F.col("_hkey")], rank).drop("_url_key", "_late", "_own", "_hkey")


def clean_articles(df: DataFrame, order: str = "ord", scope: list[str] | None = None, keep_places: bool = False) -> DataFrame:
    """FLT-01 + FLT-02 + DDP-03/04: drop null headlines, description NULL -> "", dedup."""
    base = df.dropna(subset=["headline"]).fillna({"description": ""})
    return drop_article_duplicates(base, order, scope, keep_places)


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """DDP-05: one row (rows_before, rows_after, removed) from two counts, no driver round trip."""
    counts = before.select(F.lit(1).alias("_b")).unionByName(after.select(F.lit(0).alias("_b")))
    return counts.agg(
        F.sum("_b").cast("long").alias("rows_before"),
        F.sum(1 - F.col("_b")).cast("long").alias("rows_after"),
    ).withColumn("removed", F.col("rows_before") - F.col("rows_after"))
