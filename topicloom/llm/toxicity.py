"""Operator 9: toxicity by weak supervision.

1. Voters.  From a bounded sample of labelled training rows, words and word
   beginnings that are much likelier in toxic texts become lexicons (split among
   several lexicon voters by hash) and patterns (beginnings, likewise split); further
   voters are a list of common insults and the density of lexicon hits.
2. Label model.  All documents are reduced to their votes; a generative model of the
   vote patterns (class prior, each voter's rates in either class) is fitted by EM on
   the counts of the at most ``2 ** voters`` patterns.  Voters whose votes correlate
   beyond what the class explains share their weight.  It gives every pattern a
   posterior.
3. Classifier.  A logistic regression (Spark ML) on word, pattern and voter features
   learns the posterior labels of a bounded sample of all documents.

Labels are used from rows with crc32(doc_id) mod 5 <> 0 only; doc_id, lang and source
are never features.

Defined results: a null or empty text votes for nothing and scores the model's
intercept; labels that are null or held out are ignored; a doc_id labelled twice
counts twice; without toxic training rows every score is 0; rows with equal doc_id
stay separate rows; other columns pass through ``drop_toxic`` and are ignored else.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import land, texts

FOLDS = 5
#: Bounds of the two samples: labelled rows of a class, documents the classifier is fitted on.
MAX_LABELLED = 10_000
MAX_FIT = 40_000
MAX_LEXICON, MAX_PATTERNS = 3000, 300
#: A gram needs this many toxic texts, and this share of them, and this lift over the rest.
MIN_SUPPORT, MIN_SHARE, MIN_LIFT = 4, 0.005, 30.0
LEXICONS, PATTERN_VOTERS = 5, 3
DENSE = 0.01

#: A fixed list: common English insults.
INSULTS = frozenset(
    "arrogant bastard bitch clown coward creep crap damn disgusting dumb dumbass fool freak garbage "
    "hate idiot idiotic imbecile jerk kill liar loser lunatic moron moronic nasty pathetic pig "
    "ridiculous rubbish scum shit shut sick sucker stupid trash ugly vermin worthless wretch".split()
)
_WORD = re.compile(r"\w+")
VOTERS = LEXICONS + PATTERN_VOTERS + 2


def held_out(doc_id=None):
    """Column: the row is in the held-out fold."""
    return F.crc32((F.col("doc_id") if doc_id is None else doc_id).cast("string").cast("binary")) % FOLDS == 0


def grams(words: set[str]) -> set[str]:
    """Features of a set of words: the words, and beginnings of longer ones."""
    return {"w:" + w for w in words} | {"p:" + w[:n] for w in words for n in (4, 5) if len(w) > n}


@dataclass
class Model:
    lexicon: dict[str, int] = field(default_factory=dict)  # word -> voter
    patterns: dict[str, int] = field(default_factory=dict)  # beginning -> voter
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    def tokens(self, text: str | None) -> tuple[list[str], int]:
        """Features of a text, and its votes as a bit mask."""
        words = _WORD.findall(text.lower()) if text else []
        lexicon, patterns = self.lexicon, self.patterns
        counts = set(words)
        out, mask, hits = [], 0, set()
        for w in counts:
            voter = lexicon.get(w)
            if voter is not None:
                out.append("w:" + w)
                mask |= 1 << voter
                hits.add(w)
            if w in INSULTS:
                mask |= 1 << (VOTERS - 2)
                hits.add(w)
            for n in (4, 5):
                if len(w) > n:
                    voter = patterns.get(w[:n])
                    if voter is not None:
                        out.append("p:" + w[:n])
                        mask |= 1 << voter
                        hits.add(w)
        if hits and sum(w in hits for w in words) >= DENSE * len(words):
            mask |= 1 << (VOTERS - 1)
        out += [f"v:{i}" for i in range(VOTERS) if mask >> i & 1]
        return sorted(set(out)), mask

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        get = self.weights.get
        z = self.intercept + sum(get(t, 0.0) for t in self.tokens(text)[0])
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _sampled(rows: DataFrame, n: int, bound: int, key) -> DataFrame:
    """About ``bound`` of ``n`` rows, the same whatever the partitioning."""
    if n <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int((1 << 30) * bound / n))


def induce(docs: DataFrame, labels: DataFrame) -> Model:
    """The voters' lexicons and patterns, from labelled training rows."""
    train = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out()).select("doc_id", "toxic")
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if not sizes.get(1):
        return Model()
    picked = _sampled(train.where("toxic = 1"), sizes[1], MAX_LABELLED, F.col("doc_id")).unionByName(
        _sampled(train.where("toxic = 0"), sizes.get(0, 0), MAX_LABELLED, F.col("doc_id"))
    )
    picked = land(picked, "tox-picked")
    # The sample is bounded; labels that repeat a doc_id could still exceed it, and then shuffle.
    small = F.broadcast(picked) if picked.count() <= 4 * MAX_LABELLED else picked
    rows = docs.select("doc_id", "text").join(small, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(texts(batch.column("text")), batch.column("toxic").to_pylist()):
                by[toxic].update(grams(set(_WORD.findall((text or "").lower()))))
                by[toxic][""] += 1
                if len(by[0]) + len(by[1]) > 150_000:
                    yield out(by)
                    by = (Counter(), Counter())
        yield out(by)

    def out(by) -> pa.RecordBatch:
        names = list(by[0].keys() | by[1].keys())
        return pa.RecordBatch.from_pydict({"gram": pa.array(names, pa.string()), "clean": pa.array([by[0][x] for x in names], pa.int64()), "toxic": pa.array([by[1][x] for x in names], pa.int64())})

    stats = land(rows.mapInArrow(count, "gram string, clean long, toxic long").groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "tox-grams")
    total = stats.where("gram = ''").first()
    if total is None or not total["toxic"]:
        return Model()
    lift = (F.col("toxic") / float(total["toxic"])) / ((F.col("clean") + 0.5) / (float(total["clean"]) + 1.0))
    strong = stats.where((F.col("gram") != "") & (F.col("toxic") >= max(MIN_SUPPORT, MIN_SHARE * total["toxic"]))).withColumn("lift", lift).where(F.col("lift") >= MIN_LIFT)
    model = Model()
    for kind, most, first, n in (("w:", MAX_LEXICON, 0, LEXICONS), ("p:", MAX_PATTERNS, LEXICONS, PATTERN_VOTERS)):
        top = strong.where(F.col("gram").startswith(kind)).orderBy(F.desc("toxic"), F.desc("lift"), "gram").limit(most)
        into = model.lexicon if kind == "w:" else model.patterns
        for r in top.collect():
            into[r["gram"][2:]] = first + zlib.crc32(r["gram"].encode()) % n
    return model


def features(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, tokens, mask) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            both = [m.tokens(t) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "tokens": pa.array([b[0] for b in both], pa.list_(pa.string())), "mask": pa.array([b[1] for b in both], pa.int32())})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(step, "doc_id long, tokens array<string>, mask int")


def label_model(counts: dict[int, int], rounds: int = 100) -> dict[int, float]:
    """Posterior of the toxic class for every vote pattern, by EM on pattern counts.

    Votes are binary.  Start: a pattern with a vote is likely toxic.  After each fit
    the correlation that is left between two voters within the classes lowers the
    weight of both, so a pair that always votes together counts as one voter."""
    masks = np.array(sorted(counts))
    n = np.array([counts[m] for m in masks], float)
    votes = (masks[:, None] >> np.arange(VOTERS)) & 1
    if not votes.any():
        return {int(m): 0.0 for m in masks}
    post = np.where(votes.sum(1) > 0, 0.9, 0.01)
    weight = np.ones(VOTERS)
    for r in range(rounds):
        share = np.stack([(1 - post) * n, post * n])  # class x pattern
        prior = np.clip(share.sum(1) / n.sum(), 1e-4, 1)
        rate = (share @ votes + 0.1) / (share.sum(1)[:, None] + 1.0)
        # A vote is evidence of the toxic class: the model must not turn a voter around.
        rate[1] = np.maximum(rate[1], rate[0] + 1e-6)
        rate = np.clip(rate, 1e-6, 1 - 1e-6)
        log = np.log(rate)[:, None] * votes + np.log1p(-rate)[:, None] * (1 - votes)
        each = (log[1] - log[0]) * weight
        z = each.sum(1) + np.log(prior[1]) - np.log(prior[0])
        new = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        moved = np.abs(new - post).max()
        post = new
        if r == 10 or r == 20:
            weight = 1 / (1 + correlation(votes, n, post))
        elif r > 25 and moved < 1e-9:
            break
    return {int(m): float(p) for m, p in zip(masks, post)}


def correlation(votes: np.ndarray, n: np.ndarray, post: np.ndarray) -> np.ndarray:
    """For each voter the sum of its positive correlations with others within the toxic class."""
    w = n * post
    if w.sum() < 1:
        return np.zeros(votes.shape[1])
    x = votes - (w @ votes) / w.sum()
    cov = (x * w[:, None]).T @ x / w.sum()
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.maximum(cov / np.outer(sd, sd), 0)
    np.fill_diagonal(corr, 0)
    return corr.sum(1)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The voters, the label model over all documents, and the classifier."""
    model = induce(docs, labels)
    if not model.lexicon and not model.patterns:
        return model
    spark = docs.sparkSession
    rows = land(features(docs, model), "tox-votes")
    counts = {r["mask"]: r["count"] for r in rows.groupBy("mask").count().collect()}
    posterior = label_model(counts)
    n = sum(counts.values())
    table = spark.createDataFrame([(m, p) for m, p in posterior.items()], "mask int, p double")
    # Equal patterns of features are one weighted row of the fit.
    sample = _sampled(rows, n, MAX_FIT, F.struct("doc_id", "tokens")).groupBy("tokens", "mask").agg(F.count("*").cast("double").alias("n"))
    sample = sample.join(F.broadcast(table), "mask").select("tokens", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")), F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")))).alias("y")).select("tokens", "y.*").where("weight > 1e-6")
    vocab = sorted(["w:" + w for w in model.lexicon] + ["p:" + p for p in model.patterns] + [f"v:{i}" for i in range(VOTERS)])
    vectors = CountVectorizerModel.from_vocabulary(vocab, inputCol="tokens", outputCol="features")
    train = land(sample.coalesce(8), "tox-fit")
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60, standardization=False).fit(vectors.transform(train))
    model.intercept = float(fitted.intercept)
    model.weights = {t: float(w) for t, w in zip(vocab, fitted.coefficients.toArray()) if w}
    return model


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            s = [m.score(t) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(s, pa.float64())})

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(step, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows the classifier calls toxic; other columns pass through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            yield batch.filter(pa.array([m.score(t) < 0.5 for t in texts(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(step, docs.schema)
