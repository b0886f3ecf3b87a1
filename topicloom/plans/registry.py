"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the benchmark tables at ``sf_dir`` (or what Spark derives
from them) in full.  Computed columns carry the same aliases on both sides.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from topicloom.config import ClassifierConfig
from topicloom.functions import dates, text
from topicloom.functions import html as HT
from topicloom.operators import classify as CL
from topicloom.operators import dedup, regions, report
from topicloom.operators import kmeans as KM
from topicloom.operators import nmf as NMF
from topicloom.operators import pipelines as PL
from topicloom.operators import scoring as SC
from topicloom.operators import tfidf as TF
from topicloom.operators import window_terms as WT
from topicloom.operators.joins import broadcast_if_small
from topicloom.plans import oracle as O
from topicloom.plans import preprocess as P
from topicloom.plans import train as TR
from topicloom.session import land, ship_package
from topicloom.sources import feeds as FD
from topicloom.sources import sinks as SK
from topicloom.sources import testdata as TD
from topicloom.streaming import horizon as HZ
from topicloom.streaming import stream as ST

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; the wrapper ships the package to the Python workers first."""

    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


# ------------------------------------------------------------------ shared Spark inputs


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TD.articles(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str, keep_places: bool = False, wanted: tuple[str, ...] | None = None) -> DataFrame:
    raw = dedup.with_file_row(articles(spark, sf_dir))
    return P.add_clean_columns(dedup.clean_articles(raw, keep_places=keep_places), wanted)


def processed(spark: SparkSession, sf_dir: str, keep_places: bool = False, wanted: tuple[str, ...] | None = None) -> DataFrame:
    """Processed articles; with ``wanted``, only those of the derived columns."""
    return P.add_features(cleaned(spark, sf_dir, keep_places, wanted), wanted)


# ------------------------------------------------------------------ SCL-01/02/03/05/08, DDP-06


@register("clean_headlines", _with(O.cleaned_ctes(), "SELECT ord, headline_clean, description_clean FROM cleaned"))
def q_clean_headlines(spark, sf_dir):
    return cleaned(spark, sf_dir).select("ord", "headline_clean", "description_clean")


@register("topic_text", _with(O.processed_ctes(), "SELECT ord, topic_text FROM processed"))
def q_topic_text(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    return df.select("ord", text.topic_text("headline_clean", "description_clean").alias("topic_text"))


@register(
    "dedup_keys",
    _with(
        f"articles AS ({O.articles_sql()})",
        f"SELECT ord, {O.dedup_key('headline')} AS headline_key, {O.strip_ws('coalesce(url, chr(32))')} AS url_key, "
        f"array_to_string({O.ordered_distinct('toks')}, ' ') AS headline_tokens FROM ("
        f"SELECT *, list_filter(string_split({O.rx('coalesce(headline, chr(32))', O.WS_RUN_RE, ' ')}, ' '), "
        "lambda t: length(t) > 0) AS toks FROM articles)",
    ),
)
def q_dedup_keys(spark, sf_dir):
    a = articles(spark, sf_dir)
    return a.select(
        "ord",
        text.dedup_key("headline").alias("headline_key"),
        text.strip_ws(F.coalesce("url", F.lit(" "))).alias("url_key"),
        text.dedup_tokens(F.coalesce("headline", F.lit(" "))).alias("headline_tokens"),
    )


@register(
    "text_features",
    _with(
        O.processed_ctes(),
        "SELECT ord, headline_length, headline_word_count, description_length, description_word_count FROM processed",
    ),
)
def q_text_features(spark, sf_dir):
    df = text.text_features(cleaned(spark, sf_dir))
    return df.select("ord", "headline_length", "headline_word_count", "description_length", "description_word_count")


# ------------------------------------------------------------------ DDP-01..05, FLT-01/02


@register("article_dedup", _with(O.cleaned_ctes(), "SELECT ord, headline, url, description FROM deduped"))
def q_article_dedup(spark, sf_dir):
    raw = dedup.with_file_row(articles(spark, sf_dir))
    return dedup.clean_articles(raw).select("ord", "headline", "url", "description")


@register(
    "collect_dedup",
    _with(
        f"articles AS ({O.articles_sql()})",
        "SELECT ord, headline, url FROM articles "
        "QUALIFY row_number() OVER (PARTITION BY headline, url ORDER BY ord) = 1",
    ),
)
def q_collect_dedup(spark, sf_dir):
    return dedup.drop_exact_duplicates(articles(spark, sf_dir)).select("ord", "headline", "url")


@register(
    "dedup_stats",
    _with(
        O.cleaned_ctes(),
        "SELECT (SELECT count(*) FROM articles WHERE headline IS NOT NULL) AS rows_before, "
        "(SELECT count(*) FROM deduped) AS rows_after, "
        "(SELECT count(*) FROM articles WHERE headline IS NOT NULL) - (SELECT count(*) FROM deduped) AS removed",
    ),
)
def q_dedup_stats(spark, sf_dir):
    base = articles(spark, sf_dir).dropna(subset=["headline"])
    return dedup.dedup_stats(base, dedup.drop_article_duplicates(base.fillna({"description": ""})))


# ------------------------------------------------------------------ SCL-11..13


@register(
    "time_features",
    _with(
        O.processed_ctes(),
        "SELECT ord, CAST(published_epoch AS BIGINT) AS published_epoch, "
        "CAST(hour(to_timestamp(published_epoch)) AS INTEGER) AS publication_hour, "
        "dayname(to_timestamp(published_epoch)) AS publication_day_of_week FROM processed",
    ),
)
def q_time_features(spark, sf_dir):
    df = dates.time_features(cleaned(spark, sf_dir, wanted=()))
    return df.select(
        "ord",
        F.unix_timestamp("published_at_parsed").alias("published_epoch"),
        "publication_hour",
        "publication_day_of_week",
    )


@register(
    "date_banner",
    _with(
        f"articles AS ({O.articles_sql()}), d AS (SELECT DISTINCT substr(published_at, 1, 10) AS date_string FROM articles WHERE published_at IS NOT NULL)",
        f"SELECT date_string, {O.banner_date('date_string')} AS banner FROM d",
    ),
)
def q_date_banner(spark, sf_dir):
    d = articles(spark, sf_dir).where(F.col("published_at").isNotNull())
    d = d.select(F.substring("published_at", 1, 10).alias("date_string")).distinct()
    return d.select("date_string", dates.banner_date("date_string").alias("banner"))


# ------------------------------------------------------------------ JON-01..03, AGG-02, SCL-16


@register("region_tags", _with(O.processed_ctes(), "SELECT ord, region FROM processed"))
def q_region_tags(spark, sf_dir):
    df = cleaned(spark, sf_dir, wanted=())
    return df.select("ord", regions.region_of("headline", "description").alias("region"))


@register("region_geo", _with(O.processed_ctes(), "SELECT ord, region, lat, lon FROM processed"))
def q_region_geo(spark, sf_dir):
    return regions.tag_regions(cleaned(spark, sf_dir, wanted=())).select("ord", "region", "lat", "lon")


@register(
    "region_geo_dashboard",
    _with(
        O.processed_ctes(),
        f"SELECT p.ord, p.region, coalesce(c.lat, 20.0) AS lat, coalesce(c.lon, 0.0) AS lon "
        f"FROM processed p LEFT JOIN {O.coords_values(dashboard=True)} ON c.region = p.region",
    ),
)
def q_region_geo_dashboard(spark, sf_dir):
    df = regions.tag_regions(cleaned(spark, sf_dir, wanted=()))
    return regions.add_coordinates(df, dashboard=True).select("ord", "region", "lat", "lon")


@register(
    "region_counts",
    _with(
        O.processed_ctes(),
        "SELECT region, lat, lon, count(headline) AS article_count, "
        "CAST(floor(200 + 55 * count(headline) / CASE WHEN max(count(headline)) OVER () = 0 THEN 1 ELSE max(count(headline)) OVER () END) AS INTEGER) AS intensity "
        "FROM processed GROUP BY region, lat, lon",
    ),
)
def q_region_counts(spark, sf_dir):
    return report.region_counts(processed(spark, sf_dir, wanted=("region", "lat", "lon")), with_topic=False)


# ------------------------------------------------------------------ dashboard (AGG-01/03/04/06, WIN-01, SCL-15/17, FLT-03/05..07, PRJ-01)
# Dashboard tables are checked on a stand-in prediction table: topic = ord % 6,
# score = headline word count, keywords NULL when the description is empty.
# (The real NMF scoring feeds the same operators in ``score_requests`` / ``entry``.)

STANDIN_SQL = (
    "pred AS (SELECT *, CAST(ord % 6 AS INTEGER) AS topic_id, CAST(headline_word_count AS DOUBLE) AS topic_score, "
    "CASE WHEN description_word_count = 0 THEN NULL ELSE 'topic ' || CAST(ord % 6 AS VARCHAR) || ' keywords' END AS topic_keywords "
    "FROM processed)"
)


def standin_predictions(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Processed articles under a fixed rule's topics, with the ``wanted`` columns (all if none are named)."""
    made = {"topic_score": "headline_word_count", "topic_keywords": "description_word_count"}
    need = tuple(made.get(c, c) for c in wanted) or None
    p = processed(spark, sf_dir, wanted=need).withColumn("topic_id", (F.col("ord") % 6).cast("int"))
    if not wanted or "topic_score" in wanted:
        p = p.withColumn("topic_score", F.col("headline_word_count").cast("double"))
    if not wanted or "topic_keywords" in wanted:
        words = F.concat(F.lit("topic "), (F.col("ord") % 6).cast("string"), F.lit(" keywords"))
        p = p.withColumn("topic_keywords", F.when(F.col("description_word_count") == 0, F.lit(None).cast("string")).otherwise(words))
    return p.select(*wanted) if wanted else p


def _pred_sql(body: str) -> str:
    return _with(O.processed_ctes() + ",\n" + STANDIN_SQL, body)


@register(
    "topic_summary",
    _pred_sql(
        "SELECT topic_id, count(*) AS count, arg_min(topic_keywords, ord) FILTER (WHERE topic_keywords IS NOT NULL) AS topic_keywords, "
        "CASE WHEN sum(count(*)) OVER () > 0 THEN count(*) / sum(count(*)) OVER () ELSE 0.0 END AS importance "
        "FROM pred WHERE topic_id IS NOT NULL GROUP BY topic_id"
    ),
)
def q_topic_summary(spark, sf_dir):
    return report.topic_summary(standin_predictions(spark, sf_dir, "ord", "topic_id", "topic_keywords"))


@register("topic_distribution", _pred_sql("SELECT topic_id, count(*) AS count FROM pred WHERE topic_id IS NOT NULL GROUP BY topic_id"))
def q_topic_distribution(spark, sf_dir):
    return report.topic_distribution(standin_predictions(spark, sf_dir, "topic_id"))


@register(
    "kpis",
    _pred_sql(
        "SELECT count(*) AS articles, count(DISTINCT source_name) AS sources, count(DISTINCT topic_id) AS topics, "
        "count(DISTINCT region) AS regions FROM pred"
    ),
)
def q_kpis(spark, sf_dir):
    return report.kpis(standin_predictions(spark, sf_dir, "source_name", "topic_id", "region"))


@register("mean_topic_score", _pred_sql("SELECT avg(topic_score) AS mean_topic_score FROM pred"))
def q_mean_topic_score(spark, sf_dir):
    return report.mean_score(standin_predictions(spark, sf_dir, "topic_score"))


@register(
    "top_headlines",
    _pred_sql(
        "SELECT topic_id, rank, ord, headline, topic_score, "
        "first(CASE WHEN rank = 1 THEN topic_keywords END IGNORE NULLS) OVER (PARTITION BY topic_id) AS title FROM ("
        "SELECT *, CAST(row_number() OVER (PARTITION BY topic_id ORDER BY topic_score DESC, ord) AS INTEGER) AS rank "
        "FROM pred WHERE topic_id IS NOT NULL) WHERE rank <= 8"
    ),
)
def q_top_headlines(spark, sf_dir):
    pred = standin_predictions(spark, sf_dir, "ord", "headline", "topic_id", "topic_score", "topic_keywords")
    return report.top_headlines(pred).select("topic_id", "rank", "ord", "headline", "topic_score", "title")


@register(
    "topic_colors",
    _pred_sql(
        f"SELECT DISTINCT p.topic_id, tc.hex, "
        "CAST(('0x' || substr(tc.hex, 2, 2))::INTEGER AS INTEGER) AS r, CAST(('0x' || substr(tc.hex, 4, 2))::INTEGER AS INTEGER) AS g, "
        "CAST(('0x' || substr(tc.hex, 6, 2))::INTEGER AS INTEGER) AS b "
        f"FROM pred p JOIN {O.colors_values()} ON tc.color_idx = p.topic_id % 7"
    ),
)
def q_topic_colors(spark, sf_dir):
    p = standin_predictions(spark, sf_dir, "topic_id").distinct()
    rgb = report.topic_rgb(F.col("topic_id"))
    return p.select("topic_id", report.topic_color(F.col("topic_id")).alias("hex"), rgb[0].alias("r"), rgb[1].alias("g"), rgb[2].alias("b"))


@register(
    "filter_facets",
    _pred_sql(
        "SELECT ord, source_name, region, topic_id FROM pred WHERE source_name IN ('src1', 'src2', 'src4') "
        "AND region IS NOT NULL AND topic_id IN (1, 2, 3)"
    ),
)
def q_filter_facets(spark, sf_dir):
    f = report.filter_facets(standin_predictions(spark, sf_dir, "ord", "source_name", "region", "topic_id"), sources=["src1", "src2", "src4"], topics=[1, 2, 3])
    return f.select("ord", "source_name", "region", "topic_id")


@register(
    "headline_search",
    _pred_sql(
        "SELECT ord, headline FROM pred WHERE source_name IS NOT NULL AND region IS NOT NULL AND topic_id IS NOT NULL "
        "AND contains(lower(coalesce(headline, '')), 'in')"
    ),
)
def q_headline_search(spark, sf_dir):
    return report.filter_facets(standin_predictions(spark, sf_dir, "ord", "headline", "source_name", "region", "topic_id"), search="IN").select("ord", "headline")


@register(
    "facet_options",
    _pred_sql(
        "SELECT DISTINCT facet, value FROM ("
        "SELECT 'source_name' AS facet, source_name AS value FROM pred UNION ALL "
        "SELECT 'region', region FROM pred UNION ALL SELECT 'topic_id', CAST(topic_id AS VARCHAR) FROM pred) WHERE value IS NOT NULL"
    ),
)
def q_facet_options(spark, sf_dir):
    return report.facet_options(standin_predictions(spark, sf_dir, "source_name", "region", "topic_id"))


@register(
    "article_links",
    _pred_sql(
        "SELECT CASE WHEN url IS NULL THEN headline ELSE '<a href=\"' || url || '\" target=\"_blank\">' || coalesce(headline, '') || '</a>' END AS article, "
        "topic_keywords, published_at FROM pred"
    ),
)
def q_article_links(spark, sf_dir):
    return report.article_links(standin_predictions(spark, sf_dir, "headline", "url", "topic_keywords", "published_at"))


def _map_rows(df: DataFrame) -> DataFrame:
    """The map table with the colour as text; a mode with ties is the smallest topic."""
    return df.select("region", "lat", "lon", "article_count", "topic_id", "main_topic", "intensity", F.array_join(F.col("color").cast("array<string>"), ",").alias("color"), "radius")


@register(
    "region_summary",
    _pred_sql(
        "SELECT region, lat, lon, article_count, topic_id, main_topic, intensity, '239,245,90,' || intensity AS color, 90000 AS radius FROM ("
        "SELECT g.region, lat, lon, article_count, topic_id, main_topic, "
        "CAST(floor(200 + 55 * article_count / CASE WHEN max(article_count) OVER () = 0 THEN 1 ELSE max(article_count) OVER () END) AS INTEGER) AS intensity FROM ("
        "SELECT region, lat, lon, count(headline) AS article_count, arg_min(topic_id, ord) FILTER (WHERE topic_id IS NOT NULL) AS topic_id "
        "FROM pred GROUP BY region, lat, lon) g JOIN ("
        "SELECT region, topic_id AS main_topic FROM pred WHERE topic_id IS NOT NULL GROUP BY region, topic_id "
        "QUALIFY row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, topic_id) = 1) m USING (region))"
    ),
)
def q_region_summary(spark, sf_dir):
    pred = standin_predictions(spark, sf_dir, "ord", "headline", "region", "lat", "lon", "topic_id")
    return _map_rows(report.map_layer(report.region_counts(pred, with_topic=True)))


@register(
    "usable_text",
    _with(O.processed_ctes(), f"SELECT ord, topic_text FROM processed WHERE length({O.strip_ws('coalesce(topic_text, chr(32))')}) > 0"),
)
def q_usable_text(spark, sf_dir):
    from topicloom.operators import filters

    return filters.usable_text(processed(spark, sf_dir, wanted=("topic_text",)), "topic_text").select("ord", "topic_text")


# ------------------------------------------------------------------ ML-01/02, AGG-07 (TF-IDF)



def training_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DDP-02 + FLT-03, as ``train.training_frame``; the duplicates go before any text is cleaned
    (the dedup reads headline and url alone, cleaning is row by row)."""
    base = dedup.clean_articles(dedup.with_file_row(articles(spark, sf_dir)), keep_places=True)
    kept = dedup.at_places(base, dedup.training_places(base))
    return _topic_texts(kept).withColumn("doc_id", F.col("ord"))


def _topic_texts(kept: DataFrame) -> DataFrame:
    """``kept`` articles with usable topic texts, and the columns a training frame has."""
    docs = P.add_features(P.add_clean_columns(kept, ("topic_text",)), ("topic_text",))
    return filters_usable(docs.select("ord", "ds", "headline", "url", "topic_text"))


def _tfidf_sql_ctes(where: str = "TRUE", cfg: TF.TfidfConfig | None = None) -> str:
    cfg = cfg or TF.TfidfConfig()
    stop = O.str_list(TF.english_stop_words())
    hi = f"{cfg.max_df} * (SELECT n FROM ndocs)" if isinstance(cfg.max_df, float) else str(cfg.max_df)
    return (
        O.processed_ctes()
        + f""",
train AS (
  SELECT ord AS doc_id, topic_text FROM processed
  WHERE length({O.strip_ws("coalesce(topic_text, chr(32))")}) > 0 AND ({where})
  QUALIFY row_number() OVER (PARTITION BY headline, url ORDER BY ord) = 1),
ndocs AS (SELECT count(*) AS n FROM train),
toks AS (
  SELECT doc_id, list_filter(regexp_extract_all(topic_text, '\\w\\w+'), lambda t: NOT list_contains({stop}, t)) AS s FROM train),
terms AS (
  SELECT doc_id, list_concat(s, list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1])) AS t FROM toks),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM terms) GROUP BY doc_id, term),
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM tf GROUP BY term),
vocab0 AS (
  SELECT term, df, ctf FROM stats WHERE df >= {cfg.min_df} AND df <= {hi}
  ORDER BY ctf DESC, term LIMIT {cfg.max_features}),
vocab AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_idx, df, ctf,
         ln((1.0 + (SELECT n FROM ndocs)) / (1.0 + df)) + 1.0 AS idf FROM vocab0),
weights AS (
  SELECT tf.doc_id, tf.term, v.term_idx, tf.tf * v.idf / sqrt(sum((tf.tf * v.idf) * (tf.tf * v.idf)) OVER (PARTITION BY tf.doc_id)) AS weight
  FROM tf JOIN vocab v ON v.term = tf.term)"""
    )


@register("term_stats", _with(_tfidf_sql_ctes(), "SELECT term, df, ctf FROM stats"))
def q_term_stats(spark, sf_dir):
    cfg = TF.TfidfConfig()
    tf = TF.term_counts(training_docs(spark, sf_dir), "topic_text", "doc_id", cfg)
    return TF.term_stats(tf)


@register("vocabulary", _with(_tfidf_sql_ctes(), "SELECT term, term_idx, df, round(idf, 9) AS idf FROM vocab"))
def q_vocabulary(spark, sf_dir):
    model, _ = TF.fit(training_docs(spark, sf_dir), "topic_text")
    return model.vocabulary.select("term", "term_idx", "df", F.round("idf", 9).alias("idf"))


@register("tfidf", _with(_tfidf_sql_ctes(), "SELECT doc_id, term, term_idx, round(weight, 9) AS weight FROM weights"))
def q_tfidf(spark, sf_dir):
    docs = training_docs(spark, sf_dir).select("doc_id", "topic_text").persist()  # fitted on, then weighted
    model, tf = TF.fit(docs, "topic_text")
    return TF.weights_long(tf, model).select("doc_id", "term", "term_idx", F.round("weight", 9).alias("weight"))


# ML-02: fit on the first two weeks, score the later articles with that vocabulary.
SPLIT_DS = "2024-01-14"


@register(
    "tfidf_score_new",
    _with(
        _tfidf_sql_ctes(where=f"ds <= '{SPLIT_DS}'")
        + f""",
newdocs AS (
  SELECT ord AS doc_id, topic_text FROM processed
  WHERE length({O.strip_ws("coalesce(topic_text, chr(32))")}) > 0 AND ds > '{SPLIT_DS}'),
ntoks AS (SELECT doc_id, list_filter(regexp_extract_all(topic_text, '\\w\\w+'), lambda t: NOT list_contains({O.str_list(TF.english_stop_words())}, t)) AS s FROM newdocs),
nterms AS (SELECT doc_id, list_concat(s, list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1])) AS t FROM ntoks),
ntf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM nterms) GROUP BY doc_id, term),
nw AS (
  SELECT ntf.doc_id, v.term_idx, ntf.tf * v.idf / sqrt(sum((ntf.tf * v.idf) * (ntf.tf * v.idf)) OVER (PARTITION BY ntf.doc_id)) AS weight
  FROM ntf JOIN vocab v ON v.term = ntf.term)""",
        "SELECT doc_id, term_idx, round(weight, 9) AS weight FROM nw",
    ),
)
def q_tfidf_score_new(spark, sf_dir):
    docs = training_docs(spark, sf_dir)
    model, _ = TF.fit(docs.where(F.col("ds") <= SPLIT_DS), "topic_text")
    new = processed(spark, sf_dir, wanted=("topic_text",)).where(F.col("ds") > SPLIT_DS)
    new = filters_usable(new).withColumn("doc_id", F.col("ord"))
    v = model.transform(new, "topic_text")
    return v.select("doc_id", F.posexplode("indices").alias("p", "term_idx"), "values").select(
        "doc_id", "term_idx", F.round(F.element_at("values", F.col("p") + 1), 9).alias("weight")
    )


def _window_recount(end: str) -> str:
    """A full recount of the three days up to ``end``, as SQL."""
    where = f"CAST(ds AS DATE) BETWEEN DATE '{end}' - 2 AND DATE '{end}'"
    return f"""
wtrain_{end[-2:]} AS (
  SELECT ord, topic_text FROM (
    SELECT *, row_number() OVER (PARTITION BY headline, CASE WHEN ord % 3 = 0 THEN url END ORDER BY ds, ord) AS rn FROM processed WHERE {where})
  WHERE rn = 1 AND length({O.strip_ws("coalesce(topic_text, chr(32))")}) > 0),
wtok_{end[-2:]} AS (SELECT ord, list_filter(regexp_extract_all(topic_text, '\\w\\w+'), lambda t: NOT list_contains({O.str_list(TF.english_stop_words())}, t)) AS s FROM wtrain_{end[-2:]}),
wterm_{end[-2:]} AS (SELECT ord, unnest(list_concat(s, list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1]))) AS term FROM wtok_{end[-2:]}),
wstat_{end[-2:]} AS (
  SELECT '{end}' AS window_end, term, count(DISTINCT ord) AS df, count(*) AS ctf FROM wterm_{end[-2:]} GROUP BY term
  UNION ALL SELECT '{end}', NULL, count(*), 0 FROM wtrain_{end[-2:]})"""


# The last window is counted from the days' tables, the others follow by moving it.
WINDOW_ENDS = ["2024-01-10", "2024-01-11", "2024-01-12", "2024-01-14"]


@register(
    "window_term_stats",
    _with(
        O.processed_ctes(scope="ds, ") + "," + ",".join(_window_recount(e) for e in WINDOW_ENDS),
        " UNION ALL ".join(f"SELECT * FROM wstat_{e[-2:]}" for e in WINDOW_ENDS),
    ),
)
def q_window_term_stats(spark, sf_dir):
    """ML-15 / AGG-07: the training window's term statistics as it moves over the days; each
    day's texts are counted once, when the day comes."""
    from datetime import date, timedelta

    path, stats = ST.scratch(spark, "window-processed"), ST.scratch(spark, "window-stats")
    raw = dedup.with_file_row(spark.read.parquet(_landed_articles(spark, sf_dir)).withColumn("ds", F.col("ds").cast("string")))
    days = P.add_features(P.add_clean_columns(dedup.clean_articles(raw, scope=["ds"])))
    url = F.when(F.col("ord") % 3 == 0, F.col("url")).alias("url")  # so that headlines alone come again, too
    SK.write_partitioned(days.select("ord", "ds", "headline", url, "topic_text"), path, ["ds"])
    rows = dedup.with_file_row(spark.read.parquet(path))
    start = lambda end: (date.fromisoformat(end) - timedelta(days=2)).isoformat()
    WT.add_days(rows, stats, start(WINDOW_ENDS[0]), WINDOW_ENDS[0])
    window = WT.window_stats(spark, stats, start(WINDOW_ENDS[0]), WINDOW_ENDS[0])
    out = window.select(F.lit(WINDOW_ENDS[0]).alias("window_end"), "term", "df", "ctf")
    for before, end in zip(WINDOW_ENDS, WINDOW_ENDS[1:]):
        day = date.fromisoformat(before)
        while (day := day + timedelta(days=1)) <= date.fromisoformat(end):
            WT.add_days(rows, stats, day.isoformat(), day.isoformat())
        window = land(WT.move(spark, window, stats, (start(before), before), (start(end), end)), "window-moved")
        out = out.unionByName(window.select(F.lit(end).alias("window_end"), "term", "df", "ctf"))
    return out


def filters_usable(df: DataFrame) -> DataFrame:
    from topicloom.operators import filters

    return filters.usable_text(df, "topic_text")


# ------------------------------------------------------------------ ML-03..06, WIN-02/03 (NMF)



def _fit_topics(spark: SparkSession, sf_dir: str):
    return TR.fit_topics(training_docs(spark, sf_dir))


@register("nmf_topics")
def q_nmf_topics(spark, sf_dir):
    model, _ = _fit_topics(spark, sf_dir)
    return model.terms


@register("topic_keywords")
def q_topic_keywords(spark, sf_dir):
    model, _ = _fit_topics(spark, sf_dir)
    return model.keywords.select("topic_id", "topic_keywords")


@register("nmf_assignments")
def q_nmf_assignments(spark, sf_dir):
    model, X = _fit_topics(spark, sf_dir)
    return TR.assign(model, X).select("doc_id", "topic_id", "topic_score", "topic_keywords")


@register("nmf_quality")
def q_nmf_quality(spark, sf_dir):
    model, X = _fit_topics(spark, sf_dir)
    return TR.quality(spark, model, TR.assign(model, X))


def _vectors(spark, sf_dir):
    """The TF-IDF of the training texts: (model, persisted (doc_id, indices, values))."""
    docs = training_docs(spark, sf_dir).select("doc_id", "topic_text").persist()
    tm, _ = TF.fit(docs, "topic_text")
    return tm, tm.transform(docs, "topic_text").persist()


# Fixed start for the one-step algebra check (both sides use the same rule).
ONE_STEP_K = 6


def _one_step(spark, sf_dir):
    tm, X = _vectors(spark, sf_dir)
    WtW, WtX = NMF.fixed_w_pass(X, ONE_STEP_K, tm.vocab_size, NMF.cyclic_start_w)
    return tm, NMF.multiplicative_h_step(WtW, WtX, NMF.cyclic_start_h(ONE_STEP_K, tm.vocab_size))


@register(
    "nmf_one_step",
    _with(
        _tfidf_sql_ctes()
        + f""",
topics AS (SELECT CAST(range AS INTEGER) AS j FROM range({ONE_STEP_K})),
w0 AS (SELECT t.doc_id, topics.j, 1.0 + ((t.doc_id + topics.j) % 5) * 0.25 AS w FROM train t CROSS JOIN topics),
wtx AS (SELECT w0.j, wt.term_idx, sum(w0.w * wt.weight) AS s FROM w0 JOIN weights wt ON wt.doc_id = w0.doc_id GROUP BY w0.j, wt.term_idx),
wtw AS (SELECT a.j AS i, b.j AS l, sum(a.w * b.w) AS s FROM w0 a JOIN w0 b ON a.doc_id = b.doc_id GROUP BY a.j, b.j),
h0 AS (SELECT topics.j, v.term_idx, 1.0 + ((topics.j + v.term_idx) % 3) * 0.5 AS h FROM topics CROSS JOIN vocab v),
den AS (SELECT wtw.i AS j, h0.term_idx, sum(wtw.s * h0.h) AS s FROM wtw JOIN h0 ON h0.j = wtw.l GROUP BY wtw.i, h0.term_idx)""",
        "SELECT h0.j AS topic_id, h0.term_idx, round(h0.h * coalesce(wtx.s, 0.0) / den.s, 6) AS h "
        "FROM h0 JOIN den ON den.j = h0.j AND den.term_idx = h0.term_idx "
        "LEFT JOIN wtx ON wtx.j = h0.j AND wtx.term_idx = h0.term_idx",
    ),
)
def q_nmf_one_step(spark, sf_dir):
    import numpy as np
    import pandas as pd

    _, H1 = _one_step(spark, sf_dir)
    ti, vi = np.indices(H1.shape)
    pdf = pd.DataFrame({"topic_id": ti.ravel().astype("int32"), "term_idx": vi.ravel().astype("int32"), "h": H1.ravel()})
    h = spark.createDataFrame(pdf, "topic_id int, term_idx int, h double")
    return h.select("topic_id", "term_idx", F.round("h", 6).alias("h"))


# A model with two fixed topics over the fitted vocabulary: terms of even index weigh 1 in
# topic 0 and 1/4 in topic 1, those of odd index the other way round.  With two topics
# the non-negative solution has a closed form, so SQL can check whole scores.
FIXED_K = 2


def _scores_sql(docs: str, weights: str) -> str:
    """CTEs ``b`` (X H^T), ``w`` (weights a, b of both topics) and ``scored`` of the fixed model."""
    return f"""
hf AS (SELECT term_idx, CASE WHEN term_idx % 2 = 0 THEN 1.0 ELSE 0.25 END AS h0, CASE WHEN term_idx % 2 = 1 THEN 1.0 ELSE 0.25 END AS h1 FROM vocab),
g AS (SELECT CAST(sum(h0 * h0) AS DOUBLE) AS g00, CAST(sum(h0 * h1) AS DOUBLE) AS g01, CAST(sum(h1 * h1) AS DOUBLE) AS g11 FROM hf),
b AS (SELECT d.doc_id, coalesce(sum(x.weight * hf.h0), 0.0) AS b0, coalesce(sum(x.weight * hf.h1), 0.0) AS b1, coalesce(sum(x.weight * x.weight), 0.0) AS xx
      FROM {docs} d LEFT JOIN {weights} x ON x.doc_id = d.doc_id LEFT JOIN hf ON hf.term_idx = x.term_idx GROUP BY d.doc_id),
u AS (SELECT *, (b0 * g11 - b1 * g01) / (g00 * g11 - g01 * g01) AS u0, (b1 * g00 - b0 * g01) / (g00 * g11 - g01 * g01) AS u1 FROM b, g),
w AS (SELECT *, CASE WHEN u0 >= 0 AND u1 >= 0 THEN u0 WHEN b0 * b0 / g00 >= b1 * b1 / g11 THEN b0 / g00 ELSE 0.0 END AS w0,
             CASE WHEN u0 >= 0 AND u1 >= 0 THEN u1 WHEN b0 * b0 / g00 >= b1 * b1 / g11 THEN 0.0 ELSE b1 / g11 END AS w1 FROM u),
kw AS (SELECT t AS topic_id, string_agg(term, ', ' ORDER BY term_idx) AS topic_keywords FROM (
         SELECT t, term, term_idx FROM vocab, (SELECT unnest([0, 1]) AS t) WHERE term_idx % 2 = t
         QUALIFY row_number() OVER (PARTITION BY t ORDER BY term_idx) <= 8) GROUP BY t),
scored AS (SELECT doc_id, CAST(w1 > w0 AS INTEGER) AS topic_id, greatest(w0, w1) AS topic_score FROM w)"""


def _all_weights_sql(source: str, name: str, pattern: str) -> str:
    """CTE ``name``: weights of every text of ``source`` (doc_id, text) under the fitted vocabulary."""
    return f"""
{name}_s AS (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '{pattern}'), lambda t: NOT list_contains({O.str_list(TF.english_stop_words())}, t)) AS s FROM {source}),
{name}_t AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest(list_concat(s, list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1]))) AS term FROM {name}_s) GROUP BY doc_id, term),
{name} AS (SELECT n.doc_id, v.term_idx, n.tf * v.idf / sqrt(sum((n.tf * v.idf) * (n.tf * v.idf)) OVER (PARTITION BY n.doc_id)) AS weight
  FROM {name}_t n JOIN vocab v ON v.term = n.term)"""


def _fixed_model(spark, docs) -> TR.TopicModel:
    """The fixed topics over the vocabulary fitted on the training texts, saved and loaded again."""
    import numpy as np

    tm, _ = TF.fit(docs, "topic_text")
    odd = np.arange(tm.vocab_size) % FIXED_K
    H = np.where(odd[None, :] == np.arange(FIXED_K)[:, None], 1.0, 0.25)
    terms = NMF.topic_terms(spark, H, tm.vocabulary, 8)
    path = ST.scratch(spark, "fixed-model")
    SK.save_topic_model(spark, TR.TopicModel(tm, H, NMF.keyword_table(terms), terms, 0.0, 0, tm.n_docs), path, {"algorithm": "fixed"})
    return TR.load_topic_model(spark, path)


@register(
    "score_fixed_model",
    _with(
        _tfidf_sql_ctes()
        + ", every AS (SELECT ord AS doc_id, topic_text AS text FROM processed),"
        + _all_weights_sql("every", "aw", "\\w\\w+")
        + ","
        + _scores_sql("every", "aw"),
        "SELECT doc_id AS ord, p.ds, s.topic_id, round(topic_score, 9) AS topic_score, topic_keywords "
        "FROM scored s JOIN processed p ON p.ord = s.doc_id JOIN kw ON kw.topic_id = s.topic_id",
    ),
)
def q_score_fixed_model(spark, sf_dir):
    """ML-02/04/13, WIN-03, JON-04, SRC-14: the daily scoring job over processed days, with a saved
    model that SQL can follow."""
    from topicloom.plans import jobs

    landed, out = _landed_processed(spark, sf_dir), ST.scratch(spark, "fixed-scores")
    # the landed texts are trained on and scored: articles are deduplicated and cleaned once
    trained = TR.training_frame(dedup.with_file_row(spark.read.parquet(landed)))
    jobs.score_day(spark, landed, _fixed_model(spark, trained.select("doc_id", "topic_text")), out)
    pred = spark.read.parquet(out)
    return pred.select("ord", F.col("ds").cast("string").alias("ds"), "topic_id", F.round("topic_score", 9).alias("topic_score"), "topic_keywords")


@register(
    "score_fixed_requests",
    _with(
        _tfidf_sql_ctes()
        + ", every AS (SELECT ord AS doc_id, concat_ws(chr(10), headline, description) AS text FROM articles),"
        + _all_weights_sql("every", "aw", "[\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}]{2,}")
        + ","
        + _scores_sql("every", "aw"),
        "SELECT doc_id AS request_id, s.topic_id, round(topic_score, 9) AS topic_score, topic_keywords AS keywords "
        "FROM scored s JOIN kw ON kw.topic_id = s.topic_id",
    ),
)
def q_score_fixed_requests(spark, sf_dir):
    """ML-14 + STR-04: whole raw articles scored as a stream with a saved model that SQL can follow."""
    out = _scored_requests(spark, sf_dir, _fixed_model(spark, _training_texts(spark, sf_dir)))
    return out.withColumns({"topic_score": F.round("topic_score", 9), "keywords": F.array_join("keywords", ", ")})


@register(
    "fixed_run_metrics",
    _with(
        _tfidf_sql_ctes() + "," + _scores_sql("train", "weights")
        + """, m AS (SELECT sqrt(sum(xx - 2 * (w0 * b0 + w1 * b1) + w0 * w0 * g00 + 2 * w0 * w1 * g01 + w1 * w1 * g11)) AS err,
  count(*) AS n, avg(greatest(w0, w1)) AS mean_score FROM w)""",
        "SELECT 'fixed-run' AS run_id, unnest(['reconstruction_error', 'vocabulary_size', 'training_rows', 'n_topics', 'mean_topic_score', 'iterations']) AS metric, "
        "unnest([round(err, 6), (SELECT count(*) FROM vocab), n, 2.0, round(mean_score, 6), 0.0]) AS value FROM m",
    ),
)
def q_fixed_run_metrics(spark, sf_dir):
    """ML-05, AGG-06, SNK-05: one pass over the training matrix with fixed topics; its error and the
    mean score appended as (run_id, metric, value)."""
    docs = _training_texts(spark, sf_dir)
    model = _fixed_model(spark, docs)
    X = model.vectors(docs).persist()
    WtW, _, sums = NMF.als_pass(X, model.H)
    model.reconstruction_error = NMF._error(sums, WtW, model.H)
    path = ST.scratch(spark, "fixed-run-metrics")
    SK.append_metrics(TR.quality(spark, model, TR.assign(model, X)), path, "fixed-run")
    return spark.read.parquet(path).select("run_id", "metric", F.round("value", 6).alias("value"))


@register(
    "one_step_keywords",
    ORACLES["nmf_one_step"].replace(
        "SELECT h0.j AS topic_id, h0.term_idx, round(h0.h * coalesce(wtx.s, 0.0) / den.s, 6) AS h ",
        "SELECT topic_id, string_agg(term, ', ' ORDER BY rank) AS topic_keywords FROM (SELECT topic_id, term, "
        "row_number() OVER (PARTITION BY topic_id ORDER BY h DESC, term_idx) AS rank FROM (SELECT h0.j AS topic_id, h0.term_idx, "
        "round(h0.h * coalesce(wtx.s, 0.0) / den.s, 6) AS h ",
    )
    + ") JOIN vocab USING (term_idx)) WHERE rank <= 8 GROUP BY topic_id",
)
def q_one_step_keywords(spark, sf_dir):
    """WIN-02, ML-06, SCL-09: the heaviest terms of the topics after one step from the fixed start."""
    tm, H1 = _one_step(spark, sf_dir)
    return NMF.keyword_table(NMF.topic_terms(spark, H1.round(6), tm.vocabulary, 8)).select("topic_id", "topic_keywords")


@register(
    "training_lineage",
    _with(
        O.processed_ctes()
        + """, win AS (SELECT * FROM processed WHERE ds BETWEEN '2024-01-08' AND '2024-01-10'),
kept AS (SELECT * FROM win QUALIFY row_number() OVER (PARTITION BY headline, url ORDER BY ds, ord) = 1)""",
        f"""SELECT ds AS item, count(*) AS rows FROM win GROUP BY ds
UNION ALL SELECT 'rows_read', count(*) FROM win UNION ALL SELECT 'rows_after_dedup', count(*) FROM kept
UNION ALL SELECT 'rows_with_text', count(*) FILTER (WHERE length({O.strip_ws("coalesce(topic_text, chr(32))")}) > 0) FROM kept""",
    ),
)
def q_training_lineage(spark, sf_dir):
    """ML-16: what a three-day training run read and used, from its own record: rows per day (over
    the files of the day), after the dedup, with text."""
    from topicloom.operators import filters

    df = dedup.with_file_row(FD.read_window(spark, _landed_processed(spark, sf_dir), "2024-01-08", RUN_DATE))
    kept = dedup.drop_training_duplicates(df.withColumn("_o", F.struct("ds", "ord")), "_o")
    found = TR.lineage(df, kept, filters.usable_text(kept, "topic_text"))
    days = {d: sum(f["rows"] for f in found["files"] if f["ds"] == d) for d in found["days"]}
    rows = [*days.items(), *((k, found[k]) for k in ("rows_read", "rows_after_dedup", "rows_with_text"))]
    return spark.createDataFrame(rows, "item string, rows long")


# ------------------------------------------------------------------ ML-07..09, SCL-18 (k-means)



@register(
    "kmeans_assign_fixed",
    """WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
cent AS (
  SELECT label, list(m ORDER BY i) AS c FROM (
    SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM (
      SELECT label, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS i FROM e)
    GROUP BY label, i) GROUP BY label),
cidx AS (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster_id, c FROM cent),
d AS (
  SELECT e.vec_id, cidx.cluster_id,
         sqrt(list_sum(list_transform(list_zip(e.embedding, cidx.c), lambda p: (CAST(p[1] AS DOUBLE) - p[2]) * (CAST(p[1] AS DOUBLE) - p[2])))) AS distance
  FROM e CROSS JOIN cidx),
best AS (SELECT vec_id, cluster_id, distance FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster_id) = 1)
SELECT vec_id, cluster_id, round(distance, 6) AS distance,
       round(CASE WHEN max(distance) OVER () = 0 THEN 1.0 ELSE 1.0 - distance / max(distance) OVER () END, 6) AS cluster_score
FROM best""",
)
def q_kmeans_assign_fixed(spark, sf_dir):
    emb = TD.table(spark, sf_dir, "embeddings")
    _, C = KM.centroids(emb, "embedding", "label")
    out = KM.assign(emb.select("vec_id", "embedding"), "embedding", C)
    return out.select("vec_id", "cluster_id", F.round("distance", 6).alias("distance"), F.round("cluster_score", 6).alias("cluster_score"))


@register("kmeans_clusters")
def q_kmeans_clusters(spark, sf_dir):
    """ML-07 on the embeddings: cluster sizes and inertia (k = number of labels)."""
    emb = TD.table(spark, sf_dir, "embeddings").withColumn("features", KM.as_vector("embedding"))
    k = emb.select("label").distinct().count()
    model = KM.fit(emb, "features", k)
    sizes = model.transform(emb).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.withColumn("inertia", F.lit(float(model.summary.trainingCost)))


def _training_texts(spark, sf_dir) -> DataFrame:
    """The two columns that fits and scores read more than once, kept: the texts are cleaned once."""
    from pyspark import StorageLevel

    return training_docs(spark, sf_dir).select("doc_id", "topic_text").persist(StorageLevel.MEMORY_AND_DISK)


def _kmeans_topics(docs):
    from pyspark import StorageLevel

    tm, _ = TF.fit(docs, "topic_text")
    feats = TF.features(docs, "topic_text", tm).select("doc_id", "features").persist(StorageLevel.MEMORY_AND_DISK)
    model = KM.fit(feats, "features", 6)
    return tm, SC.as_arrays(feats, "features"), model


@register("kmeans_topics")
def q_kmeans_topics(spark, sf_dir):
    """The reference's TF-IDF + k-means baseline: assignments with batch confidence."""
    import numpy as np

    tm, X, model = _kmeans_topics(_training_texts(spark, sf_dir))
    assigned = KM.assign_sparse(X, np.vstack(model.clusterCenters()))
    return KM.batch_confidence(assigned).select("doc_id", "cluster_id", "distance", "cluster_score")


@register("kmeans_saved")
def q_kmeans_saved(spark, sf_dir):
    """SNK-04 + ML-08: the k-means pipeline saved, loaded by its path in another session, and
    the training texts assigned by it."""
    docs = _training_texts(spark, sf_dir)
    tm, _, model = _kmeans_topics(docs)
    path = ST.scratch(spark, "kmeans-model")
    PL.save(spark, path, "2024-01-14", [*PL.text_stages(tm, "topic_text"), model], {"algorithm": "tfidf+kmeans", "n_topics": 6})
    loaded, _ = PL.load(spark.newSession(), path)
    return PL.score(loaded, docs, "cluster_id").drop("topic_text")


@register("kmeans_keywords")
def q_kmeans_keywords(spark, sf_dir):
    tm, _, model = _kmeans_topics(_training_texts(spark, sf_dir))
    return KM.center_keywords(model, tm.vocabulary, 8)


# ------------------------------------------------------------------ ML-10..12, AGG-05 (classifier)



def labelled_docs(spark: SparkSession, sf_dir: str, supervised: bool = True) -> DataFrame:
    """``labels`` joined to ``documents``: cleaned whole text + quality label.
    ``supervised`` applies FLT-04 (the training rows); the category
    distribution is reported before that filter, as in the reference."""
    docs = TD.table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    lab = TD.table(spark, sf_dir, "labels").select("doc_id", "quality")
    from topicloom.functions.compute import with_columns_once

    joined = with_columns_once(lab.join(docs, "doc_id"), {"text_clean": text.clean_text("text")})
    if not supervised:
        return joined
    from topicloom.operators import filters

    return filters.supervised_rows(joined, "text_clean", "quality")


LABELLED_SQL = "lab AS (SELECT l.doc_id, l.quality, d.n_chars FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"


@register(
    "category_distribution",
    _with(LABELLED_SQL, "SELECT quality, count(*) AS count, count(*) OVER () AS num_classes FROM lab GROUP BY quality"),
)
def q_category_distribution(spark, sf_dir):
    return report.category_distribution(labelled_docs(spark, sf_dir, supervised=False), "quality")


SUPERVISED_SQL = (
    "lab AS (SELECT l.doc_id, l.quality, d.n_chars FROM labels l JOIN documents d ON d.doc_id = l.doc_id "
    f"WHERE l.quality IS NOT NULL AND length({O.clean_text('d.text')}) > 0)"
)
SPLIT_SQL = (
    SUPERVISED_SQL
    + ", h AS (SELECT *, ((doc_id % 2147483648) * 2654435761 + 42) % 4294967296 AS hh, count(*) OVER (PARTITION BY quality) AS n_c FROM lab), "
    "s AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY hh) <= floor(0.2 * n_c + 0.5) "
    "THEN 'test' ELSE 'train' END AS split FROM h)"
)


@register("stratified_split", _with(SPLIT_SQL, "SELECT doc_id, quality, split FROM s"))
def q_stratified_split(spark, sf_dir):
    return CL.stratified_split(labelled_docs(spark, sf_dir), "quality", "doc_id").select("doc_id", "quality", "split")


@register(
    "class_weights",
    _with(
        SPLIT_SQL,
        "SELECT quality, count(*) AS n_c, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight "
        "FROM s WHERE split = 'train' GROUP BY quality",
    ),
)
def q_class_weights(spark, sf_dir):
    s = CL.stratified_split(labelled_docs(spark, sf_dir), "quality", "doc_id")
    return CL.class_weights(s.where(F.col("split") == "train"), "quality").select("quality", "n_c", "weight")


# rule-based predictions (long documents -> quality 1) so the report itself is SQL-checkable
REPORT_SQL = (
    LABELLED_SQL
    + """, p AS (SELECT CAST(quality AS VARCHAR) AS y, CAST(CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS VARCHAR) AS p FROM lab),
cls AS (SELECT y AS cls FROM p UNION SELECT p FROM p),
per AS (
  SELECT cls,
    (SELECT count(*) FROM p WHERE y = cls AND p = cls) AS tp,
    (SELECT count(*) FROM p WHERE y = cls) AS support,
    (SELECT count(*) FROM p WHERE p = cls) AS predicted FROM cls),
per2 AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
            CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
per3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per2)"""
)


@register(
    "classification_report",
    _with(
        REPORT_SQL,
        "SELECT cls AS label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM per3 "
        "UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM per3 "
        "UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM per3 "
        "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), "
        "round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM per3",
    ),
)
def q_classification_report(spark, sf_dir):
    d = labelled_docs(spark, sf_dir, supervised=False).withColumn("prediction", (F.col("n_chars") >= 1000).cast("int"))
    r = CL.report(d, "quality", "prediction")
    return r.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


def _classifier(spark, sf_dir, cfg: ClassifierConfig | None = None):
    """ML-10..12, SNK-04: split, fit, save as one artefact; the test rows scored by the saved one."""
    from pyspark import StorageLevel

    cfg = cfg or ClassifierConfig()
    # One cleaned narrow table feeds the split, the term statistics and the features.
    base = labelled_docs(spark, sf_dir).select("doc_id", "quality", "text_clean").persist(StorageLevel.MEMORY_AND_DISK)
    d = CL.stratified_split(base, "quality", "doc_id")
    train = d.where(F.col("split") == "train")
    tm, _ = TF.fit(train, "text_clean", "doc_id", cfg.tfidf)
    feats = TF.features(train.select("quality", "text_clean"), "text_clean", tm).select("quality", "features").persist(StorageLevel.MEMORY_AND_DISK)
    fitted = CL.fit_logistic(feats, "features", "quality", cfg.max_iter)
    feats.unpersist()
    path = ST.scratch(spark, "classifier-model")
    meta = {"algorithm": "tfidf+logistic_regression", "vocabulary_size": tm.vocab_size, "training_rows": tm.n_docs}
    PL.save(spark, path, "2024-01-14", [*PL.text_stages(tm, "text_clean"), fitted], meta)
    model, _ = PL.load(spark, path)
    return PL.score(model, d.where(F.col("split") == "test"), "prediction")


@register("text_classifier")
def q_text_classifier(spark, sf_dir):
    pred = _classifier(spark, sf_dir)
    return pred.select("doc_id", "quality", F.col("prediction").cast("int").alias("prediction"))


@register("classifier_metrics")
def q_classifier_metrics(spark, sf_dir):
    pred = _classifier(spark, sf_dir)
    return CL.report(pred.withColumn("prediction", F.col("prediction").cast("int")), "quality", "prediction")


# ------------------------------------------------------------------ SCL-04 / UDF-01 (HTML strip)



@register("page_text")
def q_page_text(spark, sf_dir):
    pages = TD.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", HT.clean_html("html").alias("text"))


# ------------------------------------------------------------------ STR-01..04, ML-13/14 (streaming, scoring)



def _events_stream(spark, sf_dir):
    schema = TD.table(spark, sf_dir, "events").schema
    s = ST.read_stream(spark, f"{sf_dir}/events.parque[t]", schema)  # a glob takes a file and a folder of part files
    return s.withColumn("ts", ST.event_time("ts"))


@register(
    "stream_window_counts",
    "SELECT CAST(epoch(ws) AS BIGINT) AS window_start, CAST(epoch(ws + INTERVAL 3 DAY) AS BIGINT) AS window_end, event_type, "
    "count(*) AS count FROM (SELECT event_type, date_trunc('day', ts) - to_days(CAST(o AS INTEGER)) AS ws "
    "FROM events CROSS JOIN unnest([0, 1, 2]) AS t(o)) GROUP BY ws, event_type",
)
def q_stream_window_counts(spark, sf_dir):
    counts = ST.window_counts(_events_stream(spark, sf_dir), "ts", "event_type")
    out, ck = ST.scratch(spark, "window-counts"), ST.scratch(spark, "window-counts-ckpt")
    ST.run_upsert(counts, out, ck)
    res = ST.latest(spark, out, ["window_start", "window_end", "event_type"], COUNTS_SCHEMA)
    return res.select(
        F.unix_timestamp("window_start").alias("window_start"), F.unix_timestamp("window_end").alias("window_end"), "event_type", "count"
    )


# Landings of events and the watermark each of them meets: three days behind the newest
# event of those before it, in whole milliseconds.
ARRIVALS_SQL = """arr AS (
  SELECT *, epoch_us(ts) AS us, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10
         + CASE WHEN event_id % 29 = 0 THEN 2 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS arrival FROM events),
landed AS (SELECT arrival, max(us) // 1000 - 3 * 86400000 AS passes FROM arr GROUP BY arrival),
marks AS (SELECT l.arrival, coalesce(max(p.passes), 0) * 1000 AS mark, row_number() OVER (ORDER BY l.arrival) - 1 AS turn
          FROM landed l LEFT JOIN landed p ON p.arrival < l.arrival GROUP BY l.arrival)"""


def _replayed_events(spark, sf_dir, name: str, build, run) -> list:
    """Land the events in turn, and after each landing run ``build(stream)`` on one checkpoint."""
    src, ck = ST.scratch(spark, f"{name}-src"), ST.scratch(spark, f"{name}-ckpt")
    arrivals = TD.event_arrivals(spark, sf_dir).withColumn("ts", ST.event_time("ts"))
    schema = arrivals.drop("arrival").schema
    return TD.land_in_turn(arrivals, src, "arrival", lambda: run(build(ST.read_stream(spark, src, schema)), ck))


@register(
    "stream_dedup",
    "WITH RECURSIVE " + ARRIVALS_SQL + """,
ok AS (SELECT a.* FROM arr a JOIN marks USING (arrival) WHERE a.us > mark AND a.us < (SELECT max(passes) FROM landed) * 1000),
kept AS (
  SELECT user_id, event_type, min(us) AS us FROM ok GROUP BY user_id, event_type
  UNION ALL
  SELECT k.user_id, k.event_type, min(o.us) FROM kept k JOIN ok o ON o.user_id = k.user_id AND o.event_type = k.event_type
  AND o.us >= k.us + 3 * 86400000000 GROUP BY k.user_id, k.event_type, k.us)
SELECT event_id, user_id, event_type, us AS ts_micros FROM kept JOIN ok USING (user_id, event_type, us)""",
)
def q_stream_dedup(spark, sf_dir):
    """STR-02: events per (user, type), one in three days, over several landings with late rows."""
    out = ST.scratch(spark, "dedup")
    with HZ.settings(spark, HZ.STATE_STORE):
        _replayed_events(
            spark, sf_dir, "dedup",
            lambda s: HZ.dedup_horizon(s.select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "3 days", "3 days"),
            lambda df, ck: ST.run_append(df, out, ck),
        )
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("ts_micros"))


WINDOWED_SQL = "WITH " + ARRIVALS_SQL + """,
win AS (SELECT a.event_type, a.arrival, m.mark, m.turn, epoch_us(date_trunc('day', ts) - to_days(CAST(o AS INTEGER))) AS ws
        FROM arr a JOIN marks m USING (arrival) CROSS JOIN unnest([0, 1, 2]) AS t(o)),
seen AS (SELECT *, ws + 3 * 86400000000 > mark AS in_time FROM win)
"""


def _late_windows(spark, sf_dir) -> tuple[str, list]:
    out = ST.scratch(spark, "late-windows")
    progress = _replayed_events(
        spark, sf_dir, "late-windows", lambda s: ST.window_counts(s, "ts", "event_type"), lambda df, ck: ST.run_upsert(df, out, ck)
    )
    return out, progress


COUNTS_SCHEMA = T.StructType(
    [T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
     T.StructField("event_type", T.StringType()), T.StructField("count", T.LongType())]
)


@register(
    "stream_late_counts",
    WINDOWED_SQL + "SELECT ws // 1000000 AS window_start, ws // 1000000 + 3 * 86400 AS window_end, event_type, count(*) AS count "
    "FROM seen WHERE in_time GROUP BY ws, event_type",
)
def q_stream_late_counts(spark, sf_dir):
    """STR-03: sliding counts over several landings; rows behind the watermark are in no count."""
    out, _ = _late_windows(spark, sf_dir)
    res = ST.latest(spark, out, ["window_start", "window_end", "event_type"], COUNTS_SCHEMA)
    return res.select(
        F.unix_timestamp("window_start").alias("window_start"), F.unix_timestamp("window_end").alias("window_end"), "event_type", "count"
    )


@register(
    "stream_late_rows",
    WINDOWED_SQL + "SELECT turn, count(*) // 3 AS rows_in, count(*) AS window_rows_in, count(*) FILTER (WHERE in_time) AS window_rows_counted, "
    "count(*) FILTER (WHERE NOT in_time) AS window_rows_dropped FROM seen GROUP BY turn",
)
def q_stream_late_rows(spark, sf_dir):
    """STR-03: what each landing brought, and how much of it came too late to count."""
    out, progress = _late_windows(spark, sf_dir)
    table = ST.late_window_counts(spark, out, ["window_start", "window_end", "event_type"], progress)
    turn = F.row_number().over(Window.orderBy("batch")) - 1  # a few micro-batches
    return table.withColumn("turn", turn.cast("long")).drop("batch")


#: Landed bytes a micro-batch takes: the number of micro-batches follows the input's size, not
#: the number of its files, and each has work for the whole cluster.
BATCH_BYTES = 1 << 30


def _landed_articles(spark, sf_dir) -> str:
    """SNK-01: land the raw articles as ds-partitioned parquet (what a collector writes)."""
    path = ST.scratch(spark, "raw-articles")
    SK.write_partitioned(articles(spark, sf_dir), path, ["ds"])
    return path


@register(
    "stream_preprocess",
    _with(
        O.processed_ctes(dedup=False),
        "SELECT ord, ds, headline_clean, headline_word_count, region, lat, lon, topic_text, "
        "CAST(published_epoch AS BIGINT) AS published_epoch FROM processed",
    ),
)
def q_stream_preprocess(spark, sf_dir):
    """STR-01: landed raw files -> row-level preprocessing as a stream (dedup is STR-02's job)."""
    path = _landed_articles(spark, sf_dir)
    schema = spark.read.parquet(path).schema
    s = ST.read_stream(spark, path, schema, max_bytes=BATCH_BYTES).dropna(subset=["headline"]).fillna({"description": ""})
    s = P.add_features(P.add_clean_columns(s))
    out, ck = ST.scratch(spark, "processed"), ST.scratch(spark, "processed-ckpt")
    ST.run_append(P.processed_columns(s), out, ck)
    res = spark.read.parquet(out)
    return res.select(
        "ord", F.col("ds").cast("string").alias("ds"), "headline_clean", "headline_word_count", "region", "lat", "lon", "topic_text",
        F.unix_timestamp("published_at_parsed").alias("published_epoch"),
    )


@register("batch_scoring")
def q_batch_scoring(spark, sf_dir):
    """ML-13: score processed articles with the fitted model (vocabulary -> W -> argmax -> keywords)."""
    from pyspark import StorageLevel

    # Deduplicated and cleaned once: the training texts are those of the scored rows that DDP-02 keeps.
    base = dedup.clean_articles(dedup.with_file_row(articles(spark, sf_dir)), keep_places=True)
    every = P.add_features(P.add_clean_columns(base, ("topic_text",)), ("topic_text",))
    docs = every.select(*dedup.PLACE, F.col("ord").alias("doc_id"), "topic_text").persist(StorageLevel.MEMORY_AND_DISK)
    model, _ = TR.fit_topics(filters_usable(dedup.at_places(docs, dedup.training_places(base))))
    return SC.score_rows(docs.select("doc_id", "topic_text"), "topic_text", model).select("doc_id", "topic_id", "topic_score", "topic_keywords")


def _scored_requests(spark, sf_dir, model) -> DataFrame:
    path = _landed_articles(spark, sf_dir)
    schema = spark.read.parquet(path).schema
    text = F.concat_ws("\n", "headline", "description")
    req = ST.read_stream(spark, path, schema, max_bytes=BATCH_BYTES).select(F.col("ord").alias("request_id"), text.alias("text"))
    scored = SC.score_rows(req, "text", model, "keywords").drop("text")
    out, ck = ST.scratch(spark, "scored"), ST.scratch(spark, "scored-ckpt")
    ST.run_append(scored, out, ck)
    return ST.read_rows(spark, out, scored.schema)


@register("score_requests")
def q_score_requests(spark, sf_dir):
    """ML-14 + STR-04: raw request texts (whole landed articles, no cleaning) scored as a stream."""
    model, _ = _fit_topics(spark, sf_dir)
    return _scored_requests(spark, sf_dir, model)


# ------------------------------------------------------------------ SRC-01..13, JON-05/06, SET-01 (sources)



def _feeds_cte() -> str:
    return f"feeds AS ({O.feeds_sql()}), labels AS ({O.feed_labels_sql()})"


@register("source_labels", _with(_feeds_cte(), "SELECT feed_key, source_name, source_section, country, language, label FROM labels"))
def q_source_labels(spark, sf_dir):
    return FD.feed_labels(TD.feeds(spark, sf_dir)).drop("api_section")


@register(
    "feed_config",
    _with(
        _feeds_cte(),
        "SELECT l.feed_key, l.label, l.country, l.language, 'https://' || l.feed_key || '.example/rss' AS url, f.api_section FROM labels l JOIN feeds f USING (feed_key)",
    ),
)
def q_feed_config(spark, sf_dir):
    """SRC-01 + SRC-02: the feeds as a YAML configuration (absent keys left out), loaded and labelled."""
    import yaml

    from topicloom.sources import dims

    feeds = [{k: v for k, v in r.asDict().items() if v is not None} for r in TD.feeds(spark, sf_dir).collect()]  # a configuration
    path = ST.scratch(spark, "feed-config")
    spark.createDataFrame([(yaml.safe_dump({"sources": feeds}),)], "value string").coalesce(1).write.text(path)
    loaded = dims.load_feeds(spark, path)
    return FD.feed_labels(loaded).join(F.broadcast(loaded.select("feed_key", "url")), "feed_key").select("feed_key", "label", "country", "language", "url", "api_section")


@register(
    "feed_join",
    _with(
        _feeds_cte() + f", items AS ({O.rss_items_sql()})",
        "SELECT i.ord, i.title AS headline, coalesce(i.description, i.summary) AS description, i.link AS url, "
        "coalesce(i.published, i.updated) AS published_at, l.source_name, l.source_section, l.country, l.language "
        "FROM items i LEFT JOIN labels l ON l.feed_key = i.feed_key",
    ),
)
def q_feed_join(spark, sf_dir):
    out = FD.normalize_rss(TD.rss_items(spark, sf_dir), TD.feeds(spark, sf_dir), strip_html=False)
    return out.drop("ingestion_timestamp")


@register(
    "api_normalize",
    _with(
        _feeds_cte() + f", res AS ({O.api_results_sql()})",
        "SELECT r.ord, CASE WHEN length(coalesce(r.f_headline, '')) > 0 THEN r.f_headline ELSE r.webTitle END AS headline, "
        "coalesce(CASE WHEN length(coalesce(r.f_trail, '')) > 0 THEN r.f_trail WHEN length(coalesce(r.f_body, '')) > 0 THEN r.f_body END, '') AS description, "
        "r.webUrl AS url, r.webPublicationDate AS published_at, f.source_name, f.source_section, f.country, f.language "
        "FROM res r JOIN feeds f ON f.feed_key = r.feed_key WHERE f.api_section IS NOT NULL",
    ),
)
def q_api_normalize(spark, sf_dir):
    feeds = TD.feeds(spark, sf_dir)
    with_api = feeds.where(F.col("api_section").isNotNull())
    res = TD.api_results(spark, sf_dir).join(broadcast_if_small(with_api.select("feed_key")), "feed_key", "left_semi")
    return FD.normalize_api(res, with_api, strip_html=False).drop("ingestion_timestamp")


@register(
    "page_slice",
    _with(
        f"articles AS ({O.articles_sql()}), p AS (SELECT ord, source_section, {O.parse_published('published_at')} AS ts FROM articles)",
        "SELECT source_section, ord, CAST(rank AS INTEGER) AS rank, CAST(ceil(rank / 50) AS INTEGER) AS page FROM ("
        "SELECT *, row_number() OVER (PARTITION BY source_section ORDER BY ts DESC, ord) AS rank FROM p "
        "WHERE ts IS NOT NULL AND CAST(to_timestamp(ts) AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20') WHERE ceil(rank / 50) <= 3",
    ),
)
def q_page_slice(spark, sf_dir):
    a = articles(spark, sf_dir).withColumn("ts", dates.parse_published("published_at"))
    out = FD.page_slice(a, "source_section", F.col("ts"), "2024-01-05", "2024-01-20", page_size=50, max_pages=3)
    return out.select("source_section", "ord", "rank", "page")


RUN_DATE = "2024-01-10"


def _landed_processed(spark, sf_dir) -> str:
    path = ST.scratch(spark, "processed-live")
    SK.write_partitioned(P.processed_columns(processed(spark, sf_dir)), path, ["ds"])
    return path


@register(
    "training_window",
    _with(
        O.processed_ctes(),
        "SELECT ord, ds, headline, ds AS file_ds FROM processed WHERE ds BETWEEN '2024-01-08' AND '2024-01-10' "
        "QUALIFY row_number() OVER (PARTITION BY headline, url ORDER BY ds, ord) = 1",
    ),
)
def q_training_window(spark, sf_dir):
    """SRC-09 + SCL-14 + DDP-02: the 3-day window ending at the run date, deduplicated across files."""
    start = spark.range(1).select(dates.window_start(F.lit(RUN_DATE), 3).cast("string")).first()[0]
    w = FD.read_window(spark, _landed_processed(spark, sf_dir), start, RUN_DATE)
    ordered = w.withColumn("_o", F.struct(F.col("ds").cast("string"), F.col("ord")))
    kept = dedup.keep_first(ordered, ["headline", "url"], "_o")
    return kept.select("ord", F.col("ds").cast("string").alias("ds"), "headline", text.date_from_path("source_file").alias("file_ds"))


@register(
    "missing_days",
    _with(
        f"articles AS ({O.articles_sql()})",
        "SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') AS day FROM generate_series(DATE '2024-01-25', DATE '2024-02-03', INTERVAL 1 DAY) t(d) "
        "WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ds AS DATE) FROM articles)",
    ),
)
def q_missing_days(spark, sf_dir):
    path = ST.scratch(spark, "raw-live")
    SK.write_partitioned(articles(spark, sf_dir), path, ["ds"])
    present = FD.read_window(spark, path, "2024-01-25", "2024-02-03")
    return FD.missing_days(spark, present, "2024-01-25", "2024-02-03").select(F.date_format("day", "yyyy-MM-dd").alias("day"))


CHANNELS = (("live", "language = 'en'", []), ("backfill", "language IN ('fr', 'de')", ["country"]), ("api", "language IS NULL OR language NOT IN ('en', 'fr', 'de')", ["country", "language"]))


@register(
    "channel_union",
    _with(
        f"articles AS ({O.articles_sql()}), u AS ("
        "SELECT ord, 'live' AS channel, 0 AS c, headline, url, country, language FROM articles WHERE language = 'en' UNION ALL "
        "SELECT ord, 'backfill', 1, headline, url, NULL, language FROM articles WHERE language IN ('fr', 'de') UNION ALL "
        "SELECT ord, 'api', 2, headline, url, NULL, NULL FROM articles WHERE language IS NULL OR language NOT IN ('en', 'fr', 'de'))",
        "SELECT ord, channel, headline, url, country, language FROM u "
        "QUALIFY row_number() OVER (PARTITION BY headline, url ORDER BY c, ord) = 1",
    ),
)
def q_channel_union(spark, sf_dir):
    """SRC-10 + SET-01 + DDP-02: three landed channels with drifting schemas, unioned and deduplicated."""
    a = articles(spark, sf_dir)
    frames = []
    for i, (name, cond, dropped) in enumerate(CHANNELS):
        path = ST.scratch(spark, f"channel-{name}")
        a.where(cond).drop(*dropped).write.mode("overwrite").parquet(path)
        frames.append(spark.read.parquet(path).withColumn("channel", F.lit(name)).withColumn("_c", F.lit(i)))
    u = FD.union_channels(frames).withColumn("_o", F.struct("_c", "ord"))
    return dedup.keep_first(u, ["headline", "url"], "_o").select("ord", "channel", "headline", "url", "country", "language")


# ------------------------------------------------------------------ SRC-03/05/08/11..14, SNK-01..05, PRJ-02


# What the strip leaves of a text without markup (there is none in documents).
STRIPPED = "trim({0}, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160))"


@register(
    "rss_scan",
    _with(
        _feeds_cte() + f", items AS ({O.rss_items_sql()})",
        "SELECT CAST(i.ord AS VARCHAR) AS guid, i.title AS headline, " + STRIPPED.format("coalesce(i.description, i.summary)") + " AS description, "
        "i.link AS url, coalesce(i.published, i.updated) AS published_at, "
        "l.source_name, l.source_section FROM items i LEFT JOIN labels l ON l.feed_key = i.feed_key",
    ),
)
def q_rss_scan(spark, sf_dir):
    """SRC-03 + SRC-04: items landed as RSS and Atom files per feed, read back with the XML source,
    whole descriptions stripped of markup, normalised."""
    items = TD.rss_items(spark, sf_dir)
    path = ST.scratch(spark, "rss")
    common = [F.col("feed_key").alias("feed"), "title", "description", "summary"]
    turn = F.col("ord") % 3
    text_link = [F.struct(F.col("link").alias("_VALUE")).alias("link")]
    atom_link = [F.array(F.struct(F.concat("link", F.lit("/edit")).alias("_href"), F.lit("edit").alias("_rel")), F.struct(F.col("link").alias("_href"), F.lit("alternate").alias("_rel"))).alias("link")]
    kinds = [
        ("item", turn != 2, [F.col("ord").cast("string").alias("guid"), *text_link, F.col("published").alias("pubDate"), "updated"]),
        ("entry", turn == 2, [F.col("ord").cast("string").alias("id"), *atom_link, "published", "updated"]),
    ]
    for tag, which, fields in kinds:
        out = items.where(which).select(*common, *fields).write.format("xml").option("rootTag", "channel" if tag == "item" else "feed").option("rowTag", tag)
        out.partitionBy("feed").mode("append").save(path)
    scanned = FD.read_feeds(spark, path).withColumn("ord", F.col("guid").cast("long"))
    norm = FD.normalize_rss(scanned, TD.feeds(spark, sf_dir), strip_html=True)
    return norm.select(F.col("ord").cast("string").alias("guid"), "headline", "description", "url", "published_at", "source_name", "source_section")


@register(
    "api_pages_scan",
    _with(
        _feeds_cte() + f", res AS ({O.api_results_sql()})",
        "SELECT r.ord, CASE WHEN length(coalesce(r.f_headline, '')) > 0 THEN r.f_headline ELSE r.webTitle END AS headline, "
        + STRIPPED.format("coalesce(CASE WHEN length(coalesce(r.f_trail, '')) > 0 THEN r.f_trail ELSE r.f_body END, '')") + " AS description, "
        "r.webUrl AS url, r.webPublicationDate AS published_at, f.source_name, f.country "
        "FROM res r JOIN feeds f ON f.feed_key = r.feed_key WHERE f.api_section IS NOT NULL",
    ),
)
def q_api_pages_scan(spark, sf_dir):
    """SRC-05 + SRC-06 + SRC-07: API results landed as JSON pages (status, pages,
    results[]) per section, read back, status-checked, exploded, normalised."""
    feeds = TD.feeds(spark, sf_dir)
    with_api = feeds.where(F.col("api_section").isNotNull())
    res = TD.api_results(spark, sf_dir).join(broadcast_if_small(with_api.select("feed_key")), "feed_key", "left_semi")
    page_no = F.floor(F.col("ord") / 50)  # at most 50 results of one section per page
    pages = res.groupBy("feed_key", page_no.alias("page")).agg(
        F.collect_list(F.struct("ord", "feed_key", "webTitle", "webUrl", "webPublicationDate", "fields")).alias("results")
    )
    doc = pages.select(F.struct(F.lit("ok").alias("status"), F.col("page").alias("currentPage"), F.col("results")).alias("response"))
    path = ST.scratch(spark, "api-pages")
    doc.write.mode("overwrite").json(path)
    scanned = FD.read_api_pages(spark, path, multi_line=False)
    norm = FD.normalize_api(scanned, with_api, strip_html=True)
    return norm.select("ord", "headline", "description", "url", "published_at", "source_name", "country")


RAW_SCHEMA = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("headline", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("source_section", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("ds", T.StringType()),
    ]
)


@register(
    "raw_csv_scan",
    _with(f"articles AS ({O.articles_sql()})", "SELECT ord, headline, description, url, published_at, ds FROM articles"),
)
def q_raw_csv_scan(spark, sf_dir):
    """SNK-01/02 + SRC-08: raw articles exported as CSV and read back with an explicit schema."""
    path = ST.scratch(spark, "raw-csv")
    SK.export_csv(articles(spark, sf_dir), path)
    return FD.read_raw_csv(spark, path, RAW_SCHEMA).select("ord", "headline", "description", "url", "published_at", "ds")


@register(
    "reprocess_history",
    _with(
        O.cleaned_ctes(scope="ds, "),
        "SELECT ord, ds, headline, headline_clean FROM cleaned",
    ),
)
def q_reprocess_history(spark, sf_dir):
    """SRC-11: every landed raw partition preprocessed in one job, dedup scoped to its own file (ds)."""
    path = ST.scratch(spark, "raw-history")
    SK.write_partitioned(articles(spark, sf_dir), path, ["ds"])
    raw = dedup.with_file_row(spark.read.parquet(path)).withColumn("ds", F.col("ds").cast("string"))
    out = P.add_clean_columns(dedup.clean_articles(raw, scope=["ds"]))
    return out.select("ord", "ds", "headline", "headline_clean")


def _landed_predictions(spark, sf_dir) -> str:
    """Stand-in predictions written ds-partitioned without a region column."""
    path = ST.scratch(spark, "predictions")
    preds = standin_predictions(spark, sf_dir).drop("region", "lat", "lon")
    SK.write_partitioned(preds.select("ord", "ds", "headline", "published_at", "country", "source_name", "topic_id"), path, ["ds"])
    return path


@register("prediction_catalog", _with(O.processed_ctes(), "SELECT DISTINCT ds FROM processed"))
def q_prediction_catalog(spark, sf_dir):
    """SRC-12: available prediction dates (newest first)."""
    return FD.prediction_dates(spark, _landed_predictions(spark, sf_dir))


@register(
    "latest_predictions",
    _with(
        O.processed_ctes(),
        "SELECT ord, ds, country AS region, CAST(published_epoch AS BIGINT) AS published_epoch FROM processed "
        "WHERE ds = (SELECT max(ds) FROM processed)",
    ),
)
def q_latest_predictions(spark, sf_dir):
    """SRC-12 + SRC-13: the newest date's predictions, region falling back to country."""
    loaded = FD.load_predictions(FD.read_day(spark, _landed_predictions(spark, sf_dir)))
    return loaded.select("ord", "ds", "region", F.unix_timestamp("published_at").alias("published_epoch"))


KPI_RANGES = [("2024-01-01", "2024-01-07"), ("2024-01-05", "2024-01-18"), ("2024-01-01", "2024-01-28"), ("2024-02-01", "2024-02-02")]


@register(
    "kpi_ranges",
    _pred_sql(
        " UNION ALL ".join(
            f"SELECT '{a}' AS first_day, '{b}' AS last_day, count(*) AS articles, count(DISTINCT source_name) AS sources, "
            f"count(DISTINCT topic_id) AS topics, count(DISTINCT region) AS regions FROM pred WHERE ds BETWEEN '{a}' AND '{b}'"
            for a, b in KPI_RANGES
        )
    ),
)
def q_kpi_ranges(spark, sf_dir):
    """AGG-03: KPIs of several ranges of days, each from the days' sketches; so few distinct values
    are counted exactly."""
    from topicloom.plans import jobs

    preds, sketches = ST.scratch(spark, "kpi-predictions"), ST.scratch(spark, "kpi-sketches")
    SK.write_partitioned(standin_predictions(spark, sf_dir, "ds", "source_name", "topic_id", "region"), preds, ["ds"])
    jobs.sketch_days(spark, preds, sketches)
    parts = [jobs.kpi_range(spark, sketches, a, b).select(F.lit(a).alias("first_day"), F.lit(b).alias("last_day"), "*") for a, b in KPI_RANGES]
    return functools.reduce(DataFrame.unionByName, parts)


@register("model_artifacts")
def q_model_artifacts(spark, sf_dir):
    """SNK-04 + SRC-14: save vocabulary / components / keywords / metadata, read the metadata back."""
    model, _ = _fit_topics(spark, sf_dir)
    path = ST.scratch(spark, "topic-model")
    kw = {str(r["topic_id"]): list(r["keywords"]) for r in model.keywords.collect()}  # k rows
    meta = {
        "model_type": "unsupervised_topic_modeling",
        "algorithm": "nmf",
        "n_topics": int(model.H.shape[0]),
        "text_column": "topic_text",
        "topic_keywords": kw,
        "reconstruction_error": model.reconstruction_error,
        "vocabulary_size": model.tfidf.vocab_size,
    }
    SK.save_topic_model(spark, model, path, meta)
    text_df = spark.read.text(f"{path}/metadata")
    schema = "model_type string, algorithm string, n_topics int, topic_keywords map<string, array<string>>, vocabulary_size int"
    parsed = text_df.select(F.from_json("value", schema).alias("m")).select("m.*")
    return parsed.select("algorithm", "n_topics", "vocabulary_size", F.explode("topic_keywords").alias("topic_id", "keywords"))


@register("saved_model_scoring")
def q_saved_model_scoring(spark, sf_dir):
    """SNK-04 + ML-13: train and save, then score every processed article as a job of its own that
    has nothing but the saved model's path."""
    from topicloom.plans import jobs

    path, landed = ST.scratch(spark, "topic-model"), _landed_processed(spark, sf_dir)
    jobs.train_window(spark, landed, path)
    return jobs.score_day(spark, landed, path, None).select("ord", "topic_id", "topic_score", "topic_keywords")


@register("run_metrics")
def q_run_metrics(spark, sf_dir):
    """SNK-05 + ML-16: quality metrics appended as (run_id, metric, value) rows and read back."""
    model, X = _fit_topics(spark, sf_dir)
    path = ST.scratch(spark, "run-metrics")
    SK.append_metrics(TR.quality(spark, model, TR.assign(model, X)), path, "nmf-run")
    return spark.read.parquet(path)


def _profile_sql() -> str:
    cols = ["ord", "headline", "description", "url", "published_at", "source_name", "source_section", "country", "language", "ds"]
    parts = [f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(DISTINCT {c}) AS \"distinct\" FROM articles" for c in cols]
    return " UNION ALL ".join(parts)


@register("explore_profile", _with(f"articles AS ({O.articles_sql()})", _profile_sql()))
def q_explore_profile(spark, sf_dir):
    """PRJ-02: profile of the raw articles (non-null and distinct counts per column)."""
    return FD.profile(articles(spark, sf_dir))


@register("topic_report")
def q_topic_report(spark, sf_dir):
    """Flagship: the dashboard's topic summary on real NMF assignments
    (preprocess -> TF-IDF -> NMF -> assignment -> AGG-01 + SCL-17)."""
    model, X = _fit_topics(spark, sf_dir)
    assigned = TR.assign(model, X).withColumn("ord", F.col("doc_id"))
    return report.topic_summary(assigned)


@register("window_topic_model")
def q_window_topic_model(spark, sf_dir):
    """ML-15 + SRC-09 + E2: the model of the 3-day window ending at the run date
    (partition-pruned scan of landed processed data, cross-day dedup, TF-IDF, NMF)."""
    from topicloom.plans import jobs

    model, _ = jobs.train_window(spark, _landed_processed(spark, sf_dir), None, run_date=RUN_DATE)
    return model.keywords.withColumn("reconstruction_error", F.lit(float(model.reconstruction_error))).withColumn(
        "training_rows", F.lit(int(model.n_docs))
    )
