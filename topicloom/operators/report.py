"""Dashboard tables (AGG-01..06, WIN-01, FLT-05..07, PRJ-01, SCL-15..17).

"First" always means smallest ``ord`` (source order) among non-null values.
Global shares (importance, map intensity) need the total over all groups;
they are computed over the already-aggregated table, whose size is bounded
by the number of topics / regions, never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.fixed import (
    DEFAULT_RGB,
    MAP_INTENSITY_BASE,
    MAP_INTENSITY_SPAN,
    MAP_RADIUS,
    TOP_HEADLINES_PER_TOPIC,
    TOPIC_COLORS,
)


def first_non_null(value: str, order: str = "ord") -> Column:
    """pandas ``groupby().first()``: first non-null value in source order."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def _share_of_total(count_col: str) -> Column:
    total = F.sum(count_col).over(Window.partitionBy())
    return F.when(total > 0, F.col(count_col) / total).otherwise(F.lit(0.0))


def topic_summary(pred: DataFrame, order: str = "ord") -> DataFrame:
    """AGG-01 + SCL-17: per topic row count, first keywords, importance share."""
    agg = (
        pred.where(F.col("topic_id").isNotNull())
        .groupBy("topic_id")
        .agg(F.count(F.lit(1)).alias("count"), first_non_null("topic_keywords", order).alias("topic_keywords"))
    )
    return agg.withColumn("importance", _share_of_total("count")).orderBy(F.desc("count"), "topic_id")


def topic_distribution(pred: DataFrame) -> DataFrame:
    """AGG-04: rows per topic that occurs, in topic order."""
    return pred.where(F.col("topic_id").isNotNull()).groupBy("topic_id").agg(F.count(F.lit(1)).alias("count")).orderBy("topic_id")


def category_distribution(df: DataFrame, column: str) -> DataFrame:
    """AGG-05: value counts, most frequent first, plus the number of classes."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("num_classes", F.count(F.lit(1)).over(Window.partitionBy())).orderBy(F.desc("count"), column)


def kpis(pred: DataFrame) -> DataFrame:
    """AGG-03: articles and distinct non-null sources / topics / regions (0 if a column is missing)."""

    def distinct(c: str) -> Column:
        return F.count_distinct(F.col(c)) if c in pred.columns else F.lit(0).cast("long")

    return pred.agg(
        F.count(F.lit(1)).alias("articles"),
        distinct("source_name").alias("sources"),
        distinct("topic_id").alias("topics"),
        distinct("region").alias("regions"),
    )


#: Columns whose distinct values the KPIs count, and the names of the counts.
KPI_COLUMNS = {"source_name": "sources", "topic_id": "topics", "region": "regions"}
#: 2 ** 12 registers: a standard error of about 1.6 %; up to some hundred values are counted exactly.
HLL_BITS = 12


def kpi_sketches(pred: DataFrame, day: str = "ds") -> DataFrame:
    """AGG-03, mergeable: per day the number of articles and a distinct-count sketch of each
    KPI column (absent columns: none).  A day's row is some kB however many articles it has."""
    present = [c for c in KPI_COLUMNS if c in pred.columns]
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), HLL_BITS).alias(f"{c}_sketch") for c in present]
    return pred.groupBy(day).agg(F.count(F.lit(1)).alias("articles"), *sketches)


def kpis_from_sketches(sketches: DataFrame) -> DataFrame:
    """AGG-03 over all days of ``sketches``: articles and (estimated) distinct counts, from the
    days' sketches alone."""

    def distinct(c: str) -> Column:
        if f"{c}_sketch" not in sketches.columns:
            return F.lit(0).cast("long")
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).cast("long")

    return sketches.agg(F.coalesce(F.sum("articles"), F.lit(0)).cast("long").alias("articles"), *[distinct(c).alias(n) for c, n in KPI_COLUMNS.items()])


def mean_score(pred: DataFrame, score: str = "topic_score") -> DataFrame:
    """AGG-06: mean topic score."""
    return pred.agg(F.avg(score).alias("mean_topic_score"))


def top_headlines(pred: DataFrame, n: int = TOP_HEADLINES_PER_TOPIC, order: str = "ord") -> DataFrame:
    """WIN-01: best ``n`` rows per topic by score (ties: source order), titled with
    the keywords of the best row.

    ``row_number() <= n`` lets Spark insert a partial per-partition group
    limit before the shuffle, so a hot topic ships at most ``n`` rows per
    map partition."""
    w = Window.partitionBy("topic_id").orderBy(F.desc("topic_score"), F.col(order))
    ranked = pred.where(F.col("topic_id").isNotNull()).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    title = F.first(F.when(F.col("rank") == 1, F.col("topic_keywords")), ignorenulls=True).over(Window.partitionBy("topic_id"))
    return ranked.withColumn("title", title)


def hex_to_rgb(hex_col: Column) -> Column:
    """SCL-15: ``#rrggbb`` -> array<int>[r, g, b]."""
    return F.array(*[F.conv(F.substring(hex_col, i, 2), 16, 10).cast("int") for i in (2, 4, 6)])


def topic_color(topic_id: Column) -> Column:
    """SCL-15: palette colour ``TOPIC_COLORS[topic_id % 7]`` as hex (NULL topic -> NULL)."""
    palette = F.array(*[F.lit(h) for h in TOPIC_COLORS])
    return F.element_at(palette, F.pmod(topic_id.cast("int"), F.lit(len(TOPIC_COLORS))) + 1)


def topic_rgb(topic_id: Column) -> Column:
    default = F.array(*[F.lit(v) for v in DEFAULT_RGB])
    return F.when(topic_id.isNull(), default).otherwise(hex_to_rgb(topic_color(topic_id)))


def region_counts(pred: DataFrame, with_topic: bool = True, order: str = "ord") -> DataFrame:
    """AGG-02 + SCL-16: per (region, lat, lon): non-null headlines, first topic
    (labelled "main topic" by the dashboard), its mode, and map intensity."""
    aggs = [F.count("headline").alias("article_count")]
    if with_topic and "topic_id" in pred.columns:
        aggs += [first_non_null("topic_id", order).alias("topic_id"), F.mode("topic_id", deterministic=True).alias("main_topic")]
    counts = pred.groupBy("region", "lat", "lon").agg(*aggs)
    mx = F.max("article_count").over(Window.partitionBy())
    denom = F.when(mx == 0, F.lit(1)).otherwise(mx)
    return counts.withColumn(
        "intensity", F.floor(F.lit(MAP_INTENSITY_BASE) + F.lit(MAP_INTENSITY_SPAN) * F.col("article_count") / denom).cast("int")
    )


def map_layer(region_table: DataFrame) -> DataFrame:
    """SCL-16 presentation columns for the map: rgba colour and fixed radius."""
    rgb = [F.lit(v) for v in DEFAULT_RGB]
    return region_table.withColumn("color", F.array(*rgb, F.col("intensity"))).withColumn("radius", F.lit(MAP_RADIUS))


def filter_facets(
    pred: DataFrame,
    sources: list[str] | None = None,
    regions: list[str] | None = None,
    topics: list[int] | None = None,
    search: str | None = None,
) -> DataFrame:
    """FLT-05 + FLT-06.  ``None`` selects every non-null value (so NULL rows
    drop even by default); an empty list selects nothing; the search is a
    case-insensitive literal substring of the headline."""
    out = pred
    for column, selected in (("source_name", sources), ("region", regions), ("topic_id", topics)):
        if column not in pred.columns:
            continue
        if selected is None:
            out = out.where(F.col(column).isNotNull())
        elif len(selected) == 0:
            out = out.where(F.lit(False))
        else:
            out = out.where(F.col(column).isin(list(selected)))
    if search and "headline" in pred.columns:
        out = out.where(F.lower(F.coalesce(F.col("headline"), F.lit(""))).contains(search.lower()))
    return out


def facet_options(pred: DataFrame) -> DataFrame:
    """FLT-07: distinct non-null values of each facet column as (facet, value), in one scan."""
    present = [c for c in ("source_name", "region", "topic_id") if c in pred.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in present])
    return pred.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()


def article_links(pred: DataFrame) -> DataFrame:
    """PRJ-01: HTML link per article (plain headline when the url is NULL)."""
    if "url" in pred.columns:
        link = F.when(
            F.col("url").isNull(), F.col("headline")
        ).otherwise(F.concat(F.lit('<a href="'), F.col("url"), F.lit('" target="_blank">'), F.coalesce(F.col("headline"), F.lit("")), F.lit("</a>")))
    else:
        link = F.col("headline")
    keep = [c for c in ("topic_keywords", "published_at") if c in pred.columns]
    return pred.select(link.alias("article"), *keep)


def latest_partition(df: DataFrame, column: str = "ds") -> DataFrame:
    """SRC-12: rows of the newest ``ds`` (the dashboard's default date)."""
    newest = df.agg(F.max(column).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(column) == F.col("_newest"), "left_semi")  # one row
