"""Row-local scoring, sliding window counts, dedup by place, feeds, sketches, saved pipelines, streams."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.config import TopicModelConfig
from topicloom.operators import dedup, filters, nmf, pipelines, report, scoring, tfidf, window_terms
from topicloom.plans import jobs
from topicloom.plans import registry as R
from topicloom.plans import train as TR
from topicloom.sources import feeds as FD
from topicloom.sources import sinks
from topicloom.streaming import horizon as HZ
from topicloom.streaming import stream as ST


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def static_plans(spark):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", prev)


TEXTS = ["alpha beta gamma", "beta gamma delta", "alpha alpha beta", None, "", "zeta", "gamma delta alpha", "the of and"]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 3)], "doc_id long, topic_text string")
    tm, _ = tfidf.fit(docs, "topic_text", config=tfidf.TfidfConfig(min_df=2))
    H = np.abs(np.random.default_rng(0).normal(size=(3, tm.vocab_size)))
    terms = nmf.topic_terms(spark, H, tm.vocabulary, 3)
    return docs, TR.TopicModel(tm, H, nmf.keyword_table(terms), terms, 0.0, 0, tm.n_docs)


# ------------------------------------------------------------------ scoring


def test_scoring_equals_the_long_way_without_exchange(spark, model, static_plans):
    docs, m = model
    scored = scoring.score_rows(docs, "topic_text", m)
    assert "Exchange" not in plan(scored) and "Join" not in plan(scored)
    pairs = tfidf.term_counts(docs, "topic_text", "doc_id", m.tfidf.config)
    want = nmf.transform(tfidf.vectors(pairs, m.tfidf), m.H).toPandas().set_index("doc_id")
    got = scored.toPandas().set_index("doc_id")
    words = {r["topic_id"]: r["topic_keywords"] for r in m.keywords.collect()}
    assert len(got) == len(TEXTS) * 3 and set(scored.columns) == {"doc_id", "topic_text", "topic_id", "topic_score", "topic_keywords"}
    for i in got.index:
        assert got.topic_id[i] == want.topic_id[i] and abs(got.topic_score[i] - want.topic_score[i]) < 1e-9
        assert got.topic_keywords[i] == words[got.topic_id[i]]
    assert got.topic_id[3] == 0 and got.topic_score[3] == 0.0  # a null text


def test_row_vectors_equal_joined_ones(spark, model, static_plans):
    docs, m = model
    assert "Exchange" not in plan(m.vectors(docs))
    long = lambda df: {r["doc_id"]: (r["indices"], np.round(r["values"], 12).tolist()) for r in df.collect()}
    assert long(m.vectors(docs)) == long(tfidf.vectors(tfidf.term_counts(docs, "topic_text"), m.tfidf))


def test_nmf_partials_add_up_as_a_tree(spark, monkeypatch):
    rng = np.random.default_rng(2)
    X = np.where(rng.random((90, 12)) < 0.3, rng.random((90, 12)), 0.0)
    rows = [(i, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for i, r in enumerate(X)]
    df = spark.createDataFrame(rows, "doc_id long, indices array<int>, values array<double>").repartition(11).persist()
    H = rng.random((3, 12))
    one = nmf.als_pass(df, H)
    monkeypatch.setattr(nmf, "FAN_IN", 2)
    many = nmf.als_pass(df, H)
    W = nmf.solve_rows(X @ H.T, H @ H.T)
    for got in (one, many):
        np.testing.assert_allclose(got[0], W.T @ W, rtol=1e-9)
        np.testing.assert_allclose(got[1], W.T @ X, rtol=1e-9, atol=1e-12)
        assert got[2][nmf.S_ROWS] == 90 and got[2][nmf.S_UNSOLVED] == 0
    assert nmf.fit(df, 3, 12, max_iter=1).converged is False and nmf.fit(df, 3, 12, max_iter=200).converged is True
    assert nmf._solve_rows(X @ H.T, H @ H.T, max_sweeps=1)[1] > 0


# ------------------------------------------------------------------ sliding window


def test_moved_window_equals_a_recount(spark):
    rng = random.Random(4)
    path, stats = ST.scratch(spark, "t-window"), ST.scratch(spark, "t-window-stats")
    days = [f"2024-03-{d:02}" for d in range(1, 8)]
    rows = [(i, rng.choice(days), f"h{rng.randint(0, 14)}", rng.choice([None, "u"]), rng.choice(["", None, "alpha beta", "beta gamma delta", "alpha gamma"])) for i in range(160)]
    sinks.write_partitioned(spark.createDataFrame(rows, "ord long, ds string, headline string, url string, topic_text string"), path, ["ds"])
    df = dedup.with_file_row(spark.read.parquet(path))
    config = TopicModelConfig()

    def recount(start, end):
        seen, counts, n = set(), {}, 0
        for o, ds, h, u, t in sorted(rows, key=lambda r: (r[1], r[0])):
            if start <= ds <= end and (h, u) not in seen:
                seen.add((h, u))
                words = (t or "").split()
                n += bool(words)
                for term in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
                    counts[term] = counts.get(term, 0) + 1
        return counts | {None: n}

    window_terms.add_days(df, stats, days[0], days[2], config)
    old, held = (days[0], days[2]), None
    for end in (3, 4, 6):
        for day in days[days.index(old[1]) + 1 : end + 1]:
            window_terms.add_days(df, stats, day, day, config)
            window_terms.add_days(df, stats, day, day, config)  # a replayed day changes nothing
        new = (days[end - 2], days[end])
        held = window_terms.move(spark, held if held is not None else window_terms.window_stats(spark, stats, *old), stats, old, new)
        got = {r["term"]: r["df"] for r in held.collect()}
        assert got == {k: v for k, v in recount(*new).items() if v} == {r["term"]: r["df"] for r in window_terms.window_stats(spark, stats, *new).collect()}
        old = new
    docs = spark.createDataFrame([(r[0], r[4]) for r in rows if old[0] <= r[1] <= old[1]], "doc_id long, topic_text string")
    fitted = window_terms.fit(held, tfidf.TfidfConfig(max_df=1.0))
    assert fitted.vocab_size > 0 and docs.count() >= fitted.n_docs == recount(*old)[None]
    with pytest.raises(ValueError, match="moves back"):
        window_terms.move(spark, held, stats, old, (days[0], days[2]))


# ------------------------------------------------------------------ dedup by place


def test_dedup_without_sorting_texts(spark, smoke_dir, static_plans):
    p = plan(R.QUERIES["article_dedup"](spark, smoke_dir))
    assert "SortAggregate" not in p and p.count("FileScan parquet") == 2 and "Exchange hashpartitioning" not in p  # places are few: broadcast


def test_channels_with_overlapping_ord_keep_all_rows(spark):
    path = ST.scratch(spark, "t-channels")
    rows = [(1, "a", None, "live"), (1, "b", "u", "api"), (2, "c", " ", "live"), (2, "c!", None, "api"), (2, "d", "u", "live"), (1, "a", "v", "api")]
    spark.createDataFrame(rows, "ord long, headline string, url string, channel string").repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    exact = dedup.keep_first(dedup.with_file_row(df), ["headline", "url"])
    assert exact.count() == 6 and set(exact.columns) == set(df.columns)
    for frame in (dedup.with_file_row(df), df):
        got = sorted((r["headline"], r["url"]) for r in dedup.drop_article_duplicates(frame).collect())
        assert got[0] == ("a", "v") and ("b", "u") in got and len([h for h, _ in got if h[0] == "c"]) == 1 and len(got) == 3
    with_ids = dedup.keep_first(dedup.with_file_row(df), ["channel"], keep_places=True)
    assert set(dedup.PLACE) < set(with_ids.columns) and with_ids.count() == 2


def test_dedup_by_place_equals_dedup_by_row(spark, smoke_dir):
    a = R.articles(spark, smoke_dir)
    key = lambda df: sorted(r["ord"] for r in df.select("ord").collect())
    assert key(dedup.clean_articles(dedup.with_file_row(a))) == key(dedup.clean_articles(a))
    assert key(dedup.clean_articles(dedup.with_file_row(a), scope=["ds"])) == key(dedup.clean_articles(a, scope=["ds"]))


# ------------------------------------------------------------------ feeds

RSS = """<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:atom="http://www.w3.org/2005/Atom" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<title>feed</title><atom:link href="https://x/self" rel="self"/>
<item><title>One</title><link>https://x/1</link><description><![CDATA[<p>Body &amp; <b>more</b></p>]]></description><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate><guid isPermaLink="false">g1</guid></item>
<item><title>Two</title><link>https://x/2</link><content:encoded>long text</content:encoded><dc:date>2024-01-02T00:00:00Z</dc:date></item>
</channel></rss>"""
RDF = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel rdf:about="https://y"><title>rdf</title></channel>
<item rdf:about="https://y/1"><title>Three</title><link>https://y/1</link><description>plain</description><dc:date>2024-01-03T00:00:00+01:00</dc:date></item></rdf:RDF>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>atom</title>
<entry><title type="html">Four</title><id>urn:4</id><link href="https://z/edit" rel="edit"/><link href="https://z/4" rel="alternate"/><summary>sum</summary><updated>2024-01-04T00:00:00Z</updated></entry>
<entry><title>Five</title><id>urn:5</id><link href="https://z/5"/><content>only content</content><published>2024-01-05T00:00:00Z</published><updated>2024-01-06T00:00:00Z</updated></entry></feed>"""


def test_feeds_of_three_formats(spark, tmp_path):
    for key, text in (("rss a", RSS), ("rdf", RDF), ("atom", ATOM)):
        (tmp_path / f"feed={key}").mkdir()
        (tmp_path / f"feed={key}" / "landed.xml").write_text(text)
    items = FD.read_feeds(spark, f"file://{tmp_path}")
    feeds = spark.createDataFrame([("rss a", "A"), ("rdf", "B"), ("atom", None)], "feed_key string, source_name string")
    feeds = feeds.withColumns({c: F.lit(None).cast("string") for c in ("name", "source_section", "category", "country", "language", "api_section")})
    got = {r["headline"]: r for r in FD.normalize_rss(items, feeds).collect()}
    assert set(got) == {"One", "Two", "Three", "Four", "Five"}
    fields = {h: (r["url"], r["published_at"], r["description"], r["source_name"]) for h, r in got.items()}
    assert fields["One"] == ("https://x/1", "Mon, 01 Jan 2024 10:00:00 GMT", "Body & more", "A")
    assert fields["Two"] == ("https://x/2", "2024-01-02T00:00:00Z", "long text", "A")
    assert fields["Three"] == ("https://y/1", "2024-01-03T00:00:00+01:00", "plain", "B")
    assert fields["Four"] == ("https://z/4", "2024-01-04T00:00:00Z", "sum", "unknown")
    assert fields["Five"] == ("https://z/5", "2024-01-05T00:00:00Z", "only content", "unknown")
    assert {r["guid"] for r in items.collect()} == {"g1", "https://x/2", "https://y/1", "urn:4", "urn:5"}


def test_a_broken_item_leaves_the_others(spark, tmp_path):
    (tmp_path / "feed=x").mkdir()
    broken = RSS.replace("<title>Two</title>", "<title>Two</titel>")
    (tmp_path / "feed=x" / "landed.xml").write_text(broken)
    got = FD.read_feeds(spark, f"file://{tmp_path}").collect()
    assert "One" in {r["title"] for r in got} and any(r["corrupt"] and "titel" in r["corrupt"] for r in got)


# ------------------------------------------------------------------ days, sketches, artefacts


def test_newest_day_reads_one_folder(spark, static_plans):
    path = ST.scratch(spark, "t-days")
    sinks.write_partitioned(spark.createDataFrame([(1, "2024-01-09"), (2, "2024-01-10"), (3, "2024-01-10")], "ord long, ds string"), path, ["ds"])
    assert [r["ds"] for r in FD.prediction_dates(spark, path).collect()] == ["2024-01-10", "2024-01-09"]
    day = FD.read_day(spark, path)
    assert sorted(map(tuple, day.collect())) == [(2, "2024-01-10"), (3, "2024-01-10")]
    assert "2024-01-09" not in "".join(day.inputFiles()) and "Aggregate" not in plan(day)
    with pytest.raises(FileNotFoundError, match="2024-02-01"):
        FD.read_day(spark, path, "2024-02-01")
    with pytest.raises(FileNotFoundError):
        jobs.preprocess_day(spark, path, ST.scratch(spark, "t-none"), "2024-02-01")
    assert FD.partition_values(spark, ST.scratch(spark, "t-absent")) == []


def test_sketches_of_many_values_stay_within_their_error(spark):
    pred = spark.range(60_000).select(F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("ds"), F.col("id").cast("string").alias("source_name"), (F.col("id") % 7).alias("topic_id"))
    got = report.kpis_from_sketches(report.kpi_sketches(pred)).first()
    assert got["articles"] == 60_000 and got["topics"] == 7 and got["regions"] == 0
    assert abs(got["sources"] - 60_000) < 0.05 * 60_000
    none = report.kpis_from_sketches(report.kpi_sketches(pred.where("false"))).first()
    assert tuple(none) == (0, 0, 0, 0)


def test_saved_pipeline_equals_the_fitted_one(spark, model):
    from topicloom.operators import kmeans

    docs, m = model
    feats = tfidf.features(docs, "topic_text", m.tfidf)
    fitted = kmeans.fit(feats, "features", 3)
    path = ST.scratch(spark, "t-pipelines")
    for version in ("2024-01-02", "2024-01-01"):
        pipelines.save(spark, path, version, [*pipelines.text_stages(m.tfidf, "topic_text"), fitted], {"k": 3})
    assert pipelines.versions(spark, path) == ["2024-01-01", "2024-01-02"]
    loaded, meta = pipelines.load(spark.newSession(), path)
    assert meta == {"k": 3, "version": "2024-01-02"}
    got = {r["doc_id"]: r["cluster_id"] for r in pipelines.score(loaded, docs, "cluster_id").collect()}
    assert got == {r["doc_id"]: r["cluster_id"] for r in fitted.transform(feats).collect()}
    with pytest.raises(FileNotFoundError):
        pipelines.load(spark, ST.scratch(spark, "t-no-pipelines"))


def test_training_records_what_it_read(spark, smoke_dir):
    import json

    processed, path, stats = (ST.scratch(spark, n) for n in ("t-processed", "t-lineage-model", "t-lineage-stats"))
    sinks.write_partitioned(R.processed(spark, smoke_dir), processed, ["ds"])
    config = TopicModelConfig(n_topics=2, max_iter=2, tfidf=tfidf.TfidfConfig(min_df=1))
    for day in ("2024-01-08", "2024-01-09", "2024-01-10"):
        jobs.count_day(spark, processed, stats, day, config)
    counted, _ = jobs.train_window(spark, processed, path, "2024-01-10", config, stats_path=stats)
    plain, _ = jobs.train_window(spark, processed, None, "2024-01-10", config)
    vocab = lambda m: sorted((r["term"], r["term_idx"], r["df"]) for r in m.tfidf.vocabulary.collect())
    assert vocab(counted) == vocab(plain) and counted.tfidf.n_docs == plain.tfidf.n_docs
    meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    lineage = meta["lineage"]
    window = spark.read.parquet(processed).where("ds between '2024-01-08' and '2024-01-10'")
    assert lineage["days"] == ["2024-01-08", "2024-01-09", "2024-01-10"] and lineage["rows_read"] == window.count() == sum(f["rows"] for f in lineage["files"])
    assert lineage["rows_with_text"] == plain.n_docs <= lineage["rows_after_dedup"] <= lineage["rows_read"]
    assert meta["fitted"]["converged"] is False
    assert filters.usable_text(window, "topic_text").count() >= plain.n_docs


# ------------------------------------------------------------------ streams


def greedy(events, horizon):
    last, out = {}, []
    for at, key in sorted(events):
        if key not in last or at - last[key] >= horizon:
            last[key] = at
            out.append((at, key))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_horizon_does_not_depend_on_batches(spark, seed):
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    events = sorted({(rng.randrange(0, 20 * 24), rng.choice("abc")) for _ in range(120)})
    results = []
    for cuts in ((0, 40, 120), (0, 15, 60, 61, 120)):
        src, out, ck = (ST.scratch(spark, f"t-horizon-{n}") for n in ("src", "out", "ck"))
        order = sorted(events, key=lambda e: e[0] + rng.randrange(0, 20))  # up to 20 hours late: within the lateness
        schema = "key string, ts timestamp"
        for a, b in zip(cuts, cuts[1:]):
            part = [(k, t0 + dt.timedelta(hours=h)) for h, k in order[a : b if b < 120 else None]]
            if not part:
                continue
            spark.createDataFrame(part, schema).repartition(2).write.mode("append").parquet(src)
            with HZ.settings(spark, HZ.STATE_STORE):
                s = ST.read_stream(spark, src, spark.read.parquet(src).schema)
                ST.run_append(HZ.dedup_horizon(s, ["key"], "ts", "3 days", "1 day"), out, ck)
        rows = spark.read.parquet(out).collect()
        results.append(sorted((int((r["ts"] - t0).total_seconds() // 3600), r["key"]) for r in rows))
    passed = max(h for h, _ in events) - 24
    want = [e for e in greedy([e for e in events], 72) if e[0] < passed]
    assert results[0] == results[1] == want and len(want) < len(events)


def test_a_replayed_batch_changes_nothing(spark):
    out = ST.scratch(spark, "t-replay")
    batch = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "ord long, ds string")
    other = spark.createDataFrame([(3, "2024-01-02")], "ord long, ds string")
    write = ST.day_writer(out)
    for n, rows in ((0, batch), (1, other), (1, other), (0, batch)):
        write(rows, n)
    got = ST.read_rows(spark, out, batch.schema)
    assert sorted(map(tuple, got.collect())) == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")]
    plain = ST.scratch(spark, "t-replay-plain")
    for n, rows in ((0, batch), (0, batch), (1, other)):
        ST.batch_writer(plain)(rows, n)
    assert spark.read.parquet(plain).count() == 3
    assert ST.read_rows(spark, ST.scratch(spark, "t-nothing"), batch.schema).count() == 0
