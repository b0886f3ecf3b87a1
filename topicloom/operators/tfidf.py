"""TF-IDF fit and transform (ML-01, ML-02, AGG-07).

Semantics (scikit-learn ``TfidfVectorizer`` defaults as configured by the
pipeline): no lower-casing; tokens are runs of two or more word characters;
stop words are removed before n-grams are formed; n-grams joined by a space;
keep terms with ``min_df <= df <= max_df`` (``max_df`` as a fraction of the
documents when it is a float); keep the ``max_features`` terms with the highest
corpus frequency (ties: term ascending); index terms alphabetically;
``idf = ln((1 + N) / (1 + df)) + 1``; ``tfidf = tf * idf``; rows L2-normalised.

MLlib's ``IDF`` has no ``+ 1`` and ``CountVectorizer`` indexes by frequency,
so the fit is written with DataFrame aggregations instead:

* term statistics are one partially aggregated shuffle by term over each row's sorted
  terms, which counts the documents too, and no (document, term) pair is kept; per-document
  term counts are computed inside each row (no shuffle of text or tokens);
* vectors are built inside the row from the fitted vocabulary (``scoring.row_vectors``);
  only an unbounded vocabulary needs ``vectors``, which assembles them by
  ``collect_list`` after a join by term;
* the vocabulary is at most ``max_features`` rows -- that bound is what makes
  it safe to collect and broadcast.  Without a bound it stays distributed and
  joins by shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from importlib import resources

from pyspark.ml.feature import NGram, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.compute import with_columns_once
from topicloom.session import land

TOKEN_PATTERN = r"(?U)\b\w\w+\b"
#: Patterns with an equal that is quicker to search: ASCII by a table, no look around.
_RUNS = {TOKEN_PATTERN: r"(?U)[" + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_" + r"[\x{80}-\x{10ffff}&&[\w]]]{2,}"}
BROADCAST_VOCAB_LIMIT = 200_000


@lru_cache(maxsize=None)
def english_stop_words() -> tuple[str, ...]:
    """The 318-word English list, read from the package's own data file."""
    text = resources.files("topicloom").joinpath("data/english_stop_words.txt").read_text(encoding="utf-8")
    return tuple(w for line in text.splitlines() if not line.startswith("#") for w in line.split())


@dataclass(frozen=True)
class TfidfConfig:
    max_features: int | None = 3000
    min_df: int | float = 2
    max_df: int | float = 0.9
    ngram_min: int = 1
    ngram_max: int = 2
    stop_words: bool = True
    token_pattern: str = TOKEN_PATTERN


@dataclass
class TfidfModel:
    config: TfidfConfig
    vocabulary: DataFrame  # term, term_idx, df, idf
    n_docs: int
    vocab_size: int

    @property
    def bounded(self) -> bool:
        """The vocabulary is small by configuration: every executor may hold it."""
        return self.config.max_features is not None and self.config.max_features <= BROADCAST_VOCAB_LIMIT

    def transform(self, docs: DataFrame, text_col: str, id_col: str = "doc_id") -> DataFrame:
        """ML-02: vectors for any documents with the fitted vocabulary (unseen terms ignored)."""
        if self.bounded:
            from topicloom.operators.scoring import row_vectors

            return row_vectors(docs, text_col, self, id_col)
        return vectors(term_counts(docs, text_col, id_col, self.config), self, id_col)


def _threshold(value: int | float, n_docs: int) -> float:
    return value * n_docs if isinstance(value, float) else float(value)


def _add_terms(docs: DataFrame, text_col: str, config: TfidfConfig) -> DataFrame:
    df = docs.withColumn(
        "_tok", F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(_RUNS.get(config.token_pattern, config.token_pattern)), 0)
    )
    if config.stop_words:
        remover = StopWordsRemover(inputCol="_tok", outputCol="_tok_sw", stopWords=list(english_stop_words()), caseSensitive=True)
        df = remover.transform(df).drop("_tok").withColumnRenamed("_tok_sw", "_tok")
    parts = []
    for n in range(config.ngram_min, config.ngram_max + 1):
        if n == 1:
            parts.append(F.col("_tok"))
        else:
            df = NGram(n=n, inputCol="_tok", outputCol=f"_ng{n}").transform(df)
            parts.append(F.col(f"_ng{n}"))
    return df.withColumn("_terms", F.concat(*parts) if len(parts) > 1 else parts[0])


def term_counts(docs: DataFrame, text_col: str, id_col: str | list[str] = "doc_id", config: TfidfConfig | None = None, count_docs: bool = False) -> DataFrame:
    """(id, term, tf) for every document; documents without terms keep one row
    with a NULL term so they still get a (zero) vector.  ``count_docs`` gives every
    document such a row, so that counts by term count the documents too.

    Counting happens inside each row -- sort the term array, find where runs
    start, take run lengths -- so no text or token array is shuffled.  The
    sorted array and the run starts are materialised (``with_columns_once``)
    so the lambdas index them in O(1) instead of re-evaluating them."""
    config = config or TfidfConfig()
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    base = docs.select(*ids, text_col)
    t = _add_terms(base, text_col, config).select(*ids, "_terms")
    t = with_columns_once(t, {"_sorted": F.sort_array("_terms")}).drop("_terms")  # array_sort calls a lambda per comparison
    n = F.size("_sorted")
    starts = F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i <= n) & ((i == 1) | (F.try_element_at("_sorted", i) != F.try_element_at("_sorted", i - 1))),
    )
    t = with_columns_once(t, {"_starts": F.when(n > 0, starts).otherwise(F.array().cast("array<int>"))})
    m = F.size("_starts")
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(m, F.lit(1))),
        lambda j: F.struct(
            F.try_element_at("_sorted", F.try_element_at("_starts", j)).alias("term"),
            (F.when(j == m, n + 1).otherwise(F.try_element_at("_starts", j + 1)) - F.try_element_at("_starts", j)).cast("int").alias("tf"),
        ),
    )
    listed = F.when(m > 0, runs)
    if count_docs:
        none = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).alias("tf")))
        listed = F.concat(none, F.coalesce(listed, F.slice(none, 1, 0)))
    counted = t.select(*ids, F.explode_outer(listed).alias("_c"))
    return counted.select(*ids, F.col("_c.term").alias("term"), F.coalesce(F.col("_c.tf"), F.lit(0)).alias("tf"))


def term_stats(tf: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """AGG-07: document frequency and corpus frequency per term."""
    return tf.where(F.col("term").isNotNull()).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("ctf")
    )


def corpus_stats(docs: DataFrame, text_col: str, config: TfidfConfig | None = None) -> DataFrame:
    """AGG-07 without per-document counts: (term, df, ctf); the NULL term's df counts the documents.

    A row's terms are sorted with one NULL before them, and each is exploded with whether
    it differs from its neighbour, all in generated code: no lambda per term."""
    config = config or TfidfConfig()
    t = _add_terms(docs.select(text_col), text_col, config).select("_terms")
    t = with_columns_once(t, {"_sorted": F.sort_array(F.concat(F.array(F.lit(None).cast("string")), "_terms"))}).drop("_terms")
    each = t.select("_sorted", F.posexplode("_sorted").alias("_pos", "term"))
    new = (F.col("_pos") == 0) | ~F.col("term").eqNullSafe(F.get("_sorted", F.col("_pos") - 1))
    return each.select("term", new.cast("int").alias("_new")).groupBy("term").agg(F.sum("_new").alias("df"), F.count(F.lit(1)).alias("ctf"))


def fit(docs: DataFrame, text_col: str, id_col: str = "doc_id", config: TfidfConfig | None = None) -> tuple[TfidfModel, DataFrame]:
    """ML-01.  Returns the model and the per-document term counts (not computed yet)."""
    config = config or TfidfConfig()
    stats = corpus_stats(docs, text_col, config).persist()
    n_docs = next((r["df"] for r in stats.where(F.col("term").isNull()).select("df").collect()), 0)
    model = fit_counts(stats.where(F.col("term").isNotNull()), n_docs, config)
    stats.unpersist()
    return model, term_counts(docs, text_col, id_col, config)


def fit_counts(stats: DataFrame, n_docs: int, config: TfidfConfig | None = None) -> TfidfModel:
    """The model from (term, df, ctf) over ``n_docs`` documents, however they were counted."""
    config = config or TfidfConfig()
    lo, hi = _threshold(config.min_df, n_docs), _threshold(config.max_df, n_docs)
    if hi < lo:
        raise ValueError("max_df corresponds to < documents than min_df")
    kept = stats.where((F.col("df") >= lo) & (F.col("df") <= hi))
    if config.max_features is not None:
        kept = kept.orderBy(F.desc("ctf"), F.asc("term")).limit(config.max_features)
    vocab, size = _index_vocabulary(stats.sparkSession, kept, n_docs, config)
    if size == 0:
        raise ValueError("After pruning, no terms remain. Try a lower min_df or a higher max_df.")
    return TfidfModel(config, vocab, n_docs, size)


def _index_vocabulary(spark: SparkSession, kept: DataFrame, n_docs: int, config: TfidfConfig) -> tuple[DataFrame, int]:
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    if config.max_features is not None and config.max_features <= BROADCAST_VOCAB_LIMIT:
        # bounded by max_features: materialise as a small local table
        rows = sorted(((r["term"], int(r["df"]), int(r["ctf"])) for r in kept.collect()), key=lambda x: x[0])
        schema = T.StructType(
            [
                T.StructField("term", T.StringType(), False),
                T.StructField("term_idx", T.IntegerType(), False),
                T.StructField("df", T.LongType(), False),
                T.StructField("ctf", T.LongType(), False),
            ]
        )
        local = spark.createDataFrame([(t, i, d, c) for i, (t, d, c) in enumerate(rows)], schema)
        return local.withColumn("idf", idf), len(rows)
    # unbounded vocabulary: alphabetical index without a single-partition sort --
    # range-partition by term, count rows per partition (one row per partition
    # reaches the driver), then offset + rank within the partition.  The ranged table is
    # written first: a lost executor must not sample other ranges.
    from pyspark.sql import Window

    ranged = land(kept.select("term", "df", "ctf").repartitionByRange("term").withColumn("_pid", F.spark_partition_id()), "vocabulary")
    sizes = sorted((r["_pid"], r["count"]) for r in ranged.groupBy("_pid").count().collect())
    offsets, acc = [], 0
    for pid, n in sizes:
        offsets.append((pid, acc))
        acc += n
    off = spark.createDataFrame(offsets, "_pid int, _off long")
    rank = F.row_number().over(Window.partitionBy("_pid").orderBy("term"))
    out = ranged.join(F.broadcast(off), "_pid").withColumn("term_idx", (F.col("_off") + rank - 1).cast("int"))
    return out.select("term", "term_idx", "df", "ctf").withColumn("idf", idf), acc


def _vocab_side(model: TfidfModel) -> DataFrame:
    v = model.vocabulary.select("term", "term_idx", "idf")
    return F.broadcast(v) if model.bounded else v


def weights_long(tf: DataFrame, model: TfidfModel, id_col: str = "doc_id") -> DataFrame:
    """(id, term, term_idx, weight): L2-normalised tf-idf in long form."""
    from pyspark.sql import Window

    j = tf.join(_vocab_side(model), "term", "inner").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return j.select(id_col, "term", "term_idx", (F.col("_w") / norm).alias("weight"))


def vectors(tf: DataFrame, model: TfidfModel, id_col: str = "doc_id") -> DataFrame:
    """(id, indices array<int>, values array<double>) sorted by index, L2-normalised.

    Every document of ``tf`` is kept; one with no vocabulary term gets empty arrays."""
    j = tf.join(_vocab_side(model), "term", "left")
    entry = F.when(F.col("term_idx").isNotNull(), F.struct(F.col("term_idx").alias("i"), (F.col("tf") * F.col("idf")).alias("w")))
    g = j.groupBy(id_col).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    norm = F.sqrt(F.aggregate("_e", F.lit(0.0), lambda acc, e: acc + e["w"] * e["w"]))
    return g.select(
        id_col,
        F.transform("_e", lambda e: e["i"]).alias("indices"),
        F.transform("_e", lambda e: e["w"] / norm).alias("values"),
    )


def add_terms(docs: DataFrame, text_col: str, config: TfidfConfig, out_col: str = "terms") -> DataFrame:
    """Term array column (tokens, stop words out, n-grams) for MLlib stages."""
    return _add_terms(docs, text_col, config).withColumnRenamed("_terms", out_col).drop(
        "_tok", *[f"_ng{n}" for n in range(2, config.ngram_max + 1)]
    )


def feature_model(model: TfidfModel, terms_col: str = "terms", out_col: str = "features"):
    """The fitted TF-IDF as JVM-native MLlib stages producing sparse ``VectorUDT``:
    counts over the alphabetical vocabulary -> idf scaling -> L2 normalisation.
    The vocabulary is at most ``max_features`` terms (collected once)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors

    rows = model.vocabulary.select("term", "term_idx", "idf").orderBy("term_idx").collect()
    cv = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], inputCol=terms_col, outputCol="_tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(p=2.0, inputCol="_tfidf", outputCol=out_col)
    return PipelineModel(stages=[cv, scale, norm])


def features(docs: DataFrame, text_col: str, model: TfidfModel, out_col: str = "features") -> DataFrame:
    with_terms = add_terms(docs, text_col, model.config)
    return feature_model(model, "terms", out_col).transform(with_terms).drop("_tf", "_tfidf", "terms")
