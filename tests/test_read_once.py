"""Texts are cleaned once, duplicates go before the cleaning, and terms are counted without lambdas."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from topicloom.operators import tfidf
from topicloom.plans import registry as R
from topicloom.plans import train as TR


@pytest.fixture(scope="module")
def own_rows(spark, tmp_path_factory):
    words = "river market school border winter budget harvest engine signal bridge".split()
    rows = [(i, f"{words[i % 10]} {words[i % 7]} {i % 31}\n" + " ".join(words[(i * j) % 10] for j in range(1, 12)), f"src{i % 3}", "en") for i in range(80)]
    rows += [(rows[5][0], *rows[5][1:]), (81, None, "src0", "de"), (82, "", None, None)]
    path = str(tmp_path_factory.mktemp("own"))
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{path}/documents.parquet")
    return path


def _count_calls(monkeypatch, module, name):
    calls, inner = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **k: calls.append(name) or inner(*a, **k))
    return calls


def test_corpus_stats_count_terms_and_documents_without_lambdas(spark):
    texts = ["bb aa bb aa bb", "aa", "", None, "cc bb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    stats = tfidf.corpus_stats(df, "t", tfidf.TfidfConfig(stop_words=False))
    per_doc = []
    for t in texts:
        w = (t or "").split()
        per_doc.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
    want = {t: (sum(t in d for d in per_doc), sum(d[t] for d in per_doc)) for d in per_doc for t in d}
    got = {r["term"]: (r["df"], r["ctf"]) for r in stats.collect()}
    assert got.pop(None)[0] == len(texts)
    assert got == want
    assert "lambda" not in stats._jdf.queryExecution().toString().lower()


@pytest.mark.parametrize("query", ["batch_scoring", "score_fixed_model"])
def test_scoring_cleans_its_texts_once(spark, own_rows, monkeypatch, query):
    cleaned = _count_calls(monkeypatch, R.P, "add_clean_columns")
    scored = R.QUERIES[query](spark, own_rows)
    assert len(cleaned) == 1
    assert scored.count() == R.processed(spark, own_rows).count() > 0


def test_training_duplicates_go_before_the_cleaning(spark, own_rows):
    cols = ["ord", "ds", "headline", "url", "topic_text", "doc_id"]
    before = TR.training_frame(R.processed(spark, own_rows, keep_places=True, wanted=("topic_text",))).select(cols)
    after = R.training_docs(spark, own_rows)
    assert after.columns == cols
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect()))
