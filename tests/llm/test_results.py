"""Whole queries on the smallest tables against brute force."""

import base64
import hashlib
import random
import re

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from topicloom.llm import bpe, decontam, jaccard, linededup, queries, toxicity, vptree
from topicloom.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").sort_index()


@pytest.fixture(scope="module")
def library():
    with open(queries.VOCABULARY, "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    assert ranks == {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.VOCABULARY, "rb"))}
    return ranks, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, docs, library):
    out = queries.QUERIES["op1_prefix_bpe"](spark, SF).toPandas().set_index("doc_id")
    for i, text in docs.text.items():
        ids = library[1].encode_ordinary(text or "")
        assert out.loc[i].tolist() == [len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()]


def test_bpe_fuzz_and_edits(library):
    ranks, enc = library
    own = bpe.PrefixBpe(ranks, P.PATTERN)
    rng = random.Random(0)
    for _ in range(500):
        s = "".join(rng.choice("ab the 'sre\n\t  1é漢ñ.,!  \x1c\x85  ") for _ in range(rng.randint(0, 60)))
        assert own.encode(s) == enc.encode_ordinary(s) and own.decode(own.encode(s)) == s.encode()
    word = lambda n: "".join(rng.choice("aabehtnirsou") for _ in range(rng.randint(0, n))).encode()
    saved = 0
    for _ in range(100):
        e = bpe.PrefixEncoding(own, word(900))
        a = rng.randint(0, len(e.data))
        b = min(len(e.data), a + rng.randint(0, 5))
        done = e.replace(a, b, word(10))
        saved += done < len(e.data) - a
        e.append(word(20))
        assert e.last == bpe.PrefixEncoding(own, e.data).last
    assert saved > 30


def test_neighbours_equal_brute_force(spark):
    vectors = pd.read_parquet(f"{SF}/embeddings.parquet")
    want = vptree.brute_force(vectors).sort_values(["query_id", "rank"]).reset_index(drop=True)
    got = queries.QUERIES["op7_vantage_trees"](spark, SF).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=1e-12)
    df = table(spark, SF, "embeddings")
    loose = vptree.search(df, df.where("vec_id % 50 = 0"), factor=1.5).toPandas()
    both = loose.merge(want, on=["query_id", "vec_id"])
    assert len(both) >= 0.9 * len(want)


def weights(text):
    lines = [" ".join(re.split(r"[ \t\r\u00a0]+", x)).strip(" ") for x in text.split("\n")]
    return [(x, x.count(" ") + 1) for x in lines]


def brute_lines(texts, min_words):
    """Texts by id without later copies of runs of min_words; copies that overlap their
    original stay."""
    first, out = {}, {}
    for i, text in sorted(texts.items()):
        lines, gone = weights(text), set()
        total = np.cumsum([0] + [w for _, w in lines])
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if total[b] - total[a] >= min_words:
                    doc, at = first.setdefault(tuple(x for x, _ in lines[a:b]), (i, a))
                    if doc != i or a >= at + b - a:
                        gone.update(range(a, b))
        out[i] = ("\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone), len(lines) - len(gone))
    return out


def test_lines_equal_brute_force(spark):
    rng = random.Random(3)
    lines = ["", "a b", "a\t b ", "c d  e f", "c d\u00a0e f", "g h i j k l m", "one two three", "x", "x\r"]
    texts = {i: "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14))) for i in range(120)}
    texts |= {120: "\n".join(["same line"] * 40), 121: "\n".join(["p q", "r s t"] * 20), 122: "\n".join(["x"] * 7)}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for least in (1, 6, 15):
        got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(d, least).collect()}
        assert got == {i: t for i, (t, _) in brute_lines(texts, least).items()}


def near(sets):
    """The smallest id of each id's component, by all pairs."""
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = list(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingle_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def test_join_equals_brute_force_in_chunks(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 60))] for _ in range(12)]
    texts = {}
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 50)}"
        texts[i] = " ".join(words + base[0][:8] * (i % 3 == 0))
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = near({i: shingle_set(t) for i, t in texts.items()})
    for chunk in (10_000, 60):  # one chunk a block, and many
        got = jaccard.jaccard_components(d, chunk).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert all(r["n_shingles"] == len(shingle_set(texts[r["doc_id"]])) for r in got)


def test_label_model_discounts_copies_of_a_voter():
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.1
    a = np.where(y, rng.random(20_000) < 0.8, rng.random(20_000) < 0.01)
    b = np.where(y, rng.random(20_000) < 0.7, rng.random(20_000) < 0.02)
    masks = a * 1 + a * 2 + b * 4  # voters 0 and 1 are one
    counts = {int(m): int(n) for m, n in zip(*np.unique(masks, return_counts=True))}
    post = toxicity.label_model(counts)
    assert post[0] < 0.1 and post[7] > 0.95
    assert np.mean((np.vectorize(post.get)(masks) > 0.5) == y) > 0.95


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.QUERIES["op9_weak_toxicity"](spark, sf).toPandas().set_index("doc_id")
    both = out.join(pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id"), how="inner")
    held = both[both.held_out]
    assert held[held.toxic == 1].predicted.mean() >= 0.9 and held[held.toxic == 0].predicted.mean() <= 0.03


def test_pipeline_equals_brute_force(spark, docs, library):
    out = corpus_pipeline.run(spark, SF).toPandas().set_index("doc_id")
    frame = table(spark, SF, "documents")
    model = toxicity.fit(frame, table(spark, SF, "labels"))
    texts = {i: t for i, t in docs.text.items() if model.score(t) < 0.5}
    texts = {i: t for i, (t, left) in brute_lines(texts, linededup.MIN_WORDS).items() if left}
    first = near({i: shingle_set(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if first[i] == i}
    items = [decontam.words_of(t) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    for i, text in list(texts.items()):
        while True:
            words = decontam.words_of(text)
            hit = {p for n in {len(w) for w in windows} for p0 in range(len(words) - n + 1) if tuple(words[p0 : p0 + n]) in windows for p in range(p0, p0 + n)}
            if not hit:
                texts[i] = text
                break
            if len(hit) >= 0.8 * len(words):
                del texts[i]
                break
            spans = [(p, next(q for q in range(p, len(words) + 1) if q not in hit)) for p in sorted(hit) if p - 1 not in hit]
            text = decontam.cut(text, spans)
    assert set(out.index) == set(texts)
    for i, text in texts.items():
        assert out.token_ids[i].tolist() == library[1].encode_ordinary(text)


def test_stages_keep_the_columns(spark):
    frame = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, SF).columns == frame.columns
