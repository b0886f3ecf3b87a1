"""Term statistics of a sliding training window (ML-15, SRC-09, AGG-07).

The window's statistics are those of its articles after the training dedup, which
keeps the first article per (headline, url) *of the window*: whether an article counts
depends on the window.  It counts if no earlier day of the window has its key, that
is, if ``gap`` -- the days back to the last day that has the key -- reaches beyond the
window's first day.  So a day's counts are kept by (gap, term), and they add up:

    window [s, e]  =  sum over its days d of the counts with gap = 0 or gap > d - s

(gap 0: not seen within ``window_days - 1`` days).  Moving the window subtracts the days
that leave, adds the days that come, and adds the articles of the days that stay whose
earlier copy left.  Texts are read once, when their day is added; a day needs the keys
of the ``window_days - 1`` days before it, 16 bytes an article.

Tables below ``path``, partitioned by ``ds``: ``keys`` (key) and ``counts`` (gap, term, df,
ctf; a null term counts the articles).  Adding a day again replaces it; if its articles
have changed, the ``window_days - 1`` days after it are to be added again, too.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.config import TopicModelConfig
from topicloom.operators import dedup, filters, tfidf
from topicloom.session import land
from topicloom.sources.sinks import write_partitioned

KEYS_SCHEMA = "key binary, ds string"
COUNTS_SCHEMA = "gap int, term string, df long, ctf long, ds string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _between(df: DataFrame, first: str, last: str) -> DataFrame:
    return df.where((F.col("ds") >= first) & (F.col("ds") <= last))


def _days_before(day: str, n: int) -> str:
    from datetime import date, timedelta

    return (date.fromisoformat(day) - timedelta(days=n)).isoformat()


def add_days(processed: DataFrame, path: str, first: str, last: str, config: TopicModelConfig | None = None) -> None:
    """Add the days ``first`` to ``last`` of processed articles (ord, ds, headline, url and the
    text column; with ``dedup.PLACE`` if read from files) to the tables below ``path``."""
    config = config or TopicModelConfig()
    spark = processed.sparkSession
    reach = config.window_days - 1
    rows = _between(processed.withColumn("ds", F.col("ds").cast("string")), first, last)
    key = dedup.key_digest(F.col("headline"), F.col("url")).alias("key")
    new = land(rows.select("ds", key).distinct(), "window-keys")
    # Each key's previous day, from the days before and the days added.
    earlier = _between(_read(spark, f"{path}/keys", KEYS_SCHEMA), _days_before(first, reach), _days_before(first, 1))
    by_key = Window.partitionBy("key").orderBy("ds")  # a row a day
    back = F.datediff(F.col("ds").cast("date"), F.lag("ds").over(by_key).cast("date"))
    gaps = new.unionByName(earlier.select("ds", "key")).withColumn("back", back).where(F.col("ds") >= first)
    gaps = gaps.select("key", "ds", F.when(F.col("back") <= reach, F.col("back")).otherwise(0).alias("gap"))
    firsts = dedup.keep_first(rows, ["ds", "headline", "url"], "ord")
    docs = filters.usable_text(firsts, config.text_column).select("ord", "ds", key, config.text_column)
    docs = docs.join(gaps, ["key", "ds"]).select("ord", "ds", "gap", config.text_column)
    terms = tfidf.term_counts(docs, config.text_column, ["ds", "gap"], config.tfidf, count_docs=True)
    counts = terms.groupBy("ds", "gap", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("ctf"))
    write_partitioned(counts, f"{path}/counts", ["ds"], skip_empty=False)
    write_partitioned(new, f"{path}/keys", ["ds"], skip_empty=False)


def _counted(start: str):
    """Whether a day's row counts in a window that starts at ``start``."""
    age = F.datediff(F.col("ds").cast("date"), F.lit(start).cast("date"))
    return (F.col("gap") == 0) | (F.col("gap") > age)


def window_stats(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """(term, df, ctf) of the window, the articles under a null term; reads its days' counts."""
    rows = _between(_read(spark, f"{path}/counts", COUNTS_SCHEMA), start, end).where(_counted(start))
    return rows.groupBy("term").agg(F.sum("df").cast("long").alias("df"), F.sum("ctf").cast("long").alias("ctf"))


def move(spark: SparkSession, stats: DataFrame, path: str, old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """The statistics of the window ``new`` from those of ``old``, which starts and ends no
    later: what leaves is subtracted, what comes is added."""
    (s0, e0), (s1, e1) = old, new
    if s1 < s0 or e1 < e0:
        raise ValueError(f"the window moves back from {s0}..{e0} to {s1}..{e1}")
    counts = _read(spark, f"{path}/counts", COUNTS_SCHEMA)
    gone = _between(counts, s0, min(e0, _days_before(s1, 1))).where(_counted(s0))
    freed = _between(counts, s1, e0).where(_counted(s1) & ~_counted(s0))
    come = _between(counts, max(s1, _days_before(e0, -1)), e1).where(_counted(s1))
    signed = [stats.select("term", "df", "ctf")]
    for part, sign in ((gone, -1), (freed, 1), (come, 1)):
        signed.append(part.select("term", (sign * F.col("df")).alias("df"), (sign * F.col("ctf")).alias("ctf")))
    out = signed[0]
    for part in signed[1:]:
        out = out.unionByName(part)
    total = out.groupBy("term").agg(F.sum("df").cast("long").alias("df"), F.sum("ctf").cast("long").alias("ctf"))
    return total.where(F.col("df") > 0)


def fit(stats: DataFrame, config: tfidf.TfidfConfig | None = None) -> tfidf.TfidfModel:
    """ML-01 from the window's statistics: no text is read."""
    held = stats.persist()
    n_docs = next((r["df"] for r in held.where(F.col("term").isNull()).select("df").collect()), 0)
    model = tfidf.fit_counts(held.where(F.col("term").isNotNull()), n_docs, config)
    held.unpersist()
    return model
