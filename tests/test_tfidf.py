"""ML-01/02: TF-IDF values on a hand-computable corpus."""

import math

from topicloom.operators import tfidf as TF


def _docs(spark):
    return spark.createDataFrame(
        [(1, "apple banana"), (2, "apple cherry"), (3, "apple banana banana"), (4, "the of")],
        "doc_id long, t string",
    )


def test_idf_and_norms(spark):
    cfg = TF.TfidfConfig(max_features=None, min_df=1, max_df=1.0, ngram_min=1, ngram_max=1, stop_words=True)
    model, tf = TF.fit(_docs(spark), "t", "doc_id", cfg)
    assert model.n_docs == 4
    v = {r["term"]: (r["term_idx"], r["df"], r["idf"]) for r in model.vocabulary.collect()}
    assert list(sorted(v, key=lambda t: v[t][0])) == ["apple", "banana", "cherry"]
    assert math.isclose(v["apple"][2], math.log(5 / 4) + 1)
    assert math.isclose(v["cherry"][2], math.log(5 / 2) + 1)
    vec = {r["doc_id"]: (list(r["indices"]), list(r["values"])) for r in TF.vectors(tf, model).collect()}
    assert vec[4] == ([], [])  # stop words only -> zero vector, row kept
    a, b = v["apple"][2], 2 * v["banana"][2]
    n = math.hypot(a, b)
    assert vec[3][0] == [0, 1]
    assert all(math.isclose(x, y) for x, y in zip(vec[3][1], [a / n, b / n]))


def test_pruning_and_max_features(spark):
    cfg = TF.TfidfConfig(max_features=1, min_df=1, max_df=0.9, ngram_min=1, ngram_max=2, stop_words=True)
    model, _ = TF.fit(_docs(spark), "t", "doc_id", cfg)
    # apple: df 3 <= 3.6 kept; highest corpus frequency among kept terms is banana (3) vs apple (3): tie -> term order
    assert [r["term"] for r in model.vocabulary.collect()] == ["apple"]


def test_bigrams_skip_stop_words(spark):
    df = spark.createDataFrame([(1, "rocket of launch")], "doc_id long, t string")
    cfg = TF.TfidfConfig(max_features=None, min_df=1, max_df=1.0)
    tf = TF.term_counts(df, "t", "doc_id", cfg)
    assert {r["term"] for r in tf.collect()} == {"rocket", "launch", "rocket launch"}


def test_transform_ignores_unseen_terms(spark):
    cfg = TF.TfidfConfig(max_features=None, min_df=1, max_df=1.0, ngram_max=1)
    model, _ = TF.fit(_docs(spark), "t", "doc_id", cfg)
    new = spark.createDataFrame([(9, "banana durian")], "doc_id long, t string")
    r = model.transform(new, "t").first()
    assert list(r["indices"]) == [1] and math.isclose(r["values"][0], 1.0)


def test_mllib_feature_stages_match(spark):
    cfg = TF.TfidfConfig(max_features=None, min_df=1, max_df=1.0, ngram_max=2)
    model, tf = TF.fit(_docs(spark), "t", "doc_id", cfg)
    from pyspark.ml.functions import vector_to_array

    ml = TF.features(_docs(spark), "t", model).select("doc_id", vector_to_array("features").alias("x"))
    ours = {r["doc_id"]: dict(zip(r["indices"], r["values"])) for r in TF.vectors(tf, model).collect()}
    for r in ml.collect():
        dense = {i: x for i, x in enumerate(r["x"]) if x != 0}
        assert set(dense) == set(ours[r["doc_id"]])
        assert all(math.isclose(dense[i], ours[r["doc_id"]][i]) for i in dense)
