"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import zlib
from collections import Counter

import pytest

from odd_rows import CLASH, LONG, ROWS
from topicloom.llm import bpe, decontam, htmlmain, jaccard, linededup, pii, sharding, toxicity, vptree, warc
from topicloom.llm.common import components, new_path
from topicloom.llm.queries import VOCABULARY

PATTERN = __import__("public_tokenizers").PATTERN


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_bpe(odd_docs, no_docs):
    out = rows(bpe.encode_documents(odd_docs, VOCABULARY, PATTERN, with_ids=True))
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in out) == Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in ROWS)
    assert all(len(r["token_ids"]) == r["n_tokens"] for r in out)
    assert rows(bpe.encode_documents(no_docs, VOCABULARY, PATTERN)) == []


def test_shards(odd_docs, no_docs):
    out = rows(sharding.shard_documents(odd_docs))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    assert max(Counter(r["shard"] for r in out).values()) == 1  # 13 rows, 16 shards
    assert rows(sharding.shard_documents(no_docs)) == []


def test_ring_moves_only_what_overflows():
    nodes = sharding.ring(4, 8, 8)
    counts = {i: 10 for i in range(256)}
    caps = sharding.capacities(2560, 4, 0.0)
    out = sharding.allocate(counts, nodes, caps, 256)
    assert Counter(s for _, lo, hi, s, _ in out for _ in range(lo, hi + 1)) == Counter(dict(enumerate(caps)))
    home = Counter()
    for at in counts:
        home[next((s for p, s in nodes if p >= at), nodes[0][1])] += 10
    stayed = sum(hi - lo + 1 for at, lo, hi, s, _ in out if s == next((s for p, s in nodes if p >= at), nodes[0][1]))
    assert stayed >= sum(min(home[s], caps[s]) for s in range(4))


def test_decontam(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "two words"), (1, "Two  WORDS!"), (2, None), (3, ""), (None, "beta gamma delta"), (4, "word " * 12)], "item_id long, text string")
    out = {(r["doc_id"], r["n_words"]): r for r in rows(decontam.report(odd_docs, items))}
    assert len(out) == 12  # the repeated row is the same
    assert out[9, 2]["n_hit"] == 2 and out[9, 2]["n_items"] == 1 and out[9, 2]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert out[1, 9]["items_sha256"] == hashlib.sha256(b"null").hexdigest() and out[1, 9]["n_hit"] == 3
    assert out[6, 30_001]["n_hit"] == 30_000 and not out[3, 0]["contaminated"]
    # Small blocks, also ones that cut an item, give the same.
    small = {(r["doc_id"], r["n_words"]): r for r in rows(decontam.report(odd_docs, items, block_words=5))}
    assert small == out
    assert rows(decontam.report(no_docs, items)) == []
    assert not any(r["contaminated"] for r in rows(decontam.report(odd_docs, items.where("1 = 0"))))
    left = rows(decontam.remove_leaks(odd_docs, items))
    assert {r["doc_id"] for r in left} == {1, 2, 3, 4, 5, 8, None}
    assert next(r for r in left if r["doc_id"] == 1)["text"] == "Alpha\nepsilon zeta.\nSecond line here"
    assert set(left[0]) == set(odd_docs.columns)


def test_cut_joins_no_window(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, "x y z q r s t u v o p " + item[: len(item) // 2] + item + item[len(item) // 2 :])], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontam.remove_leaks(docs, items, max_coverage=1.1)
    assert not rows(decontam.report(left, items))[0]["contaminated"]


def test_pii(odd_docs, no_docs, spark):
    out = rows(pii.pseudonymise(odd_docs))
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((i, t) for i, t, _ in ROWS)
    assert rows(pii.pseudonymise(no_docs)) == []
    texts = ["card 4111 1111 1111 1111, not 4111 1111 1111 1112.", "on 2024-02-29 and 31.12.1999 not 2023-02-29", "ip 10.0.0.1. not 300.1.1.1", "call +1 (414) 555-3519!", "a.b@c.example.org"]
    d = spark.createDataFrame([(i, x) for i, t in enumerate(texts * 2) for x in [t]], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(pii.pseudonymise(d, "k1"))}
    other = {r["doc_id"]: r for r in rows(pii.pseudonymise(d, "k2"))}
    for i, t in enumerate(texts):
        assert got[i]["text"] == got[i + len(texts)]["text"] != t and got[i]["text"] != other[i]["text"]
    assert [got[i]["n_found"] for i in range(5)] == [1, 2, 1, 1, 1]
    assert "4111 1111 1111 1112" in got[0]["text"] and "2023-02-29" in got[1]["text"] and "300.1.1.1" in got[2]["text"]
    number = got[0]["text"][5:24].replace(" ", "")
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    assert len(number) == 16 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def test_feistel_is_a_permutation(spark):
    d = spark.range(1000).selectExpr("lpad(cast(id as string), 3, '0') as d")
    assert d.selectExpr(pii.digits_feistel("k", "t", "d") + " as p").distinct().count() == 1000
    n = 12
    d = spark.range(n * n).selectExpr(f"cast(id div {n} as long) as x", f"id % {n} as y")
    assert d.selectExpr(pii.pair_feistel("k", "t", "x", "y", n, "concat_ws(',', s.a, s.b)") + " as p").distinct().count() == n * n


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [0.0, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (100, [-1.0, 0.0])]
    d = spark.createDataFrame([(i, x, "clash") for i, x in v], "vec_id long, embedding array<float>, score string")
    out = rows(vptree.search(d, d.where("vec_id % 50 = 0"), shard_rows=2, block_rows=1))
    by = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in out}
    assert [by[0, i][0] for i in (1, 2, 3, 4)] == [1, 50, 8, 100] and by[0, 1][1] == 1.0 and (0, 5) not in by
    assert [by[100, i][0] for i in (1, 2, 3, 4)] == [8, 0, 1, 50]
    assert rows(vptree.search(d.where("1 = 0"), d)) == [] == rows(vptree.search(d, d.where("1 = 0")))


def test_jaccard(odd_docs, no_docs):
    out = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(jaccard.jaccard_components(odd_docs)))
    n = 5
    long = len({tuple(LONG.split()[i : i + 5]) for i in range(len(LONG.split()) - 4)})
    assert out == Counter({(1, n, 1): 2, (2, n, 1): 1, (2, 2, 2): 1, (3, 0, 3): 1, (4, 0, 4): 1, (5, 0, 5): 1, (None, 1, None): 1, (6, long, 6): 1, (7, long, 6): 1, (8, 2, 8): 1, (9, 1, 9): 1, (10, 1, 9): 1})
    assert rows(jaccard.jaccard_components(no_docs)) == []
    kept = rows(jaccard.keep_one(odd_docs))
    assert Counter(r["doc_id"] for r in kept) == Counter({1: 2, 2: 2, 3: 1, 4: 1, 5: 1, None: 1, 6: 1, 8: 1, 9: 1})
    assert set(kept[0]) == set(odd_docs.columns)


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 100), (7, 7)]
    got = {r["v"]: r["comp"] for r in components(spark.createDataFrame(path, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_toxicity(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(1, 11)] + [(1, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = rows(toxicity.score_documents(odd_docs, toxicity.fit(odd_docs, labels)))
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    assert {r["doc_id"]: r["held_out"] for r in out if r["doc_id"]} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(1, 11)}
    for d, lab in ((odd_docs, labels.where("1 = 0")), (no_docs, labels)):
        model = toxicity.fit(d, lab)
        assert all(r["score"] == 0 for r in rows(toxicity.score_documents(d, model)))
        assert toxicity.drop_toxic(d, model).count() == d.count()


def test_lines(odd_docs, no_docs):
    out = rows(linededup.dedup_lines(odd_docs, min_words=9))
    by = Counter((r["doc_id"], r["text"], r["n_deleted"]) for r in out)
    short = ROWS[0][1]
    assert by[1, short, 0] == 2 and by[2, "", 2] == 1 and by[7, "", 1] == 1 and by[6, LONG, 0] == 1 and by[3, None, 0] == 1
    assert sum(by.values()) == len(ROWS) and set(out[0]) == set(odd_docs.columns) | {"n_deleted"}
    assert rows(linededup.dedup_lines(no_docs)) == []


def test_warc(spark):
    page = "<p>" + "x" * 200
    data = [(1, "http://a/", page), (1, "http://a/", page), (2, None, page), (3, "u\r\nX: y", None), (4, "http://b", ""), (5, "h", "short"), (6, "h", "short"), (None, "h", page), (7, "h", "é" * 300_000)]
    d = spark.createDataFrame([(*r, "clash") for r in data], "page_id long, url string, html string, digest string")
    folder = new_path(spark, "warc-test")
    index = warc.write_bundles(d, folder, frame_bytes=500)
    out = rows(warc.read_bundles(index, folder, with_payload=True))
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in out) == Counter(
        {(1, "response", None, 203): 2, (2, "revisit", 1, 203): 1, (3, "response", None, 0): 1, (4, "response", None, 0): 1, (5, "response", None, 5): 1, (6, "response", None, 5): 1, (None, "revisit", 1, 203): 1, (7, "response", None, 600_000): 1}
    )
    assert all(r["payload_digest"] == hashlib.sha256(r["payload"]).hexdigest() for r in out if r["record_type"] == "response")
    assert warc.read_record(index, folder, 7)["payload"] == ("é" * 300_000).encode()
    assert rows(warc.archive_round_trip(d.where("1 = 0"))) == []


def test_bundle_is_plain_zstandard(spark):
    import io

    import pyarrow.fs as pafs
    import zstandard

    d = spark.createDataFrame([(i, "http://a/", f"<p>page {i}") for i in range(50)], "page_id long, url string, html string").coalesce(1)
    folder = new_path(spark, "warc-plain")
    warc.write_bundles(d, folder, frame_bytes=1000).count()
    fs, base = warc.open_fs(folder)
    (info,) = fs.get_file_info(pafs.FileSelector(base))
    data = fs.open_input_file(info.path).read()
    text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert text.count(b"WARC/1.1\r\n") == 50


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; x < 5", "plain & x < 5"),
        ("<nav>m</nav><article><h1>T</h1><p><b>a  b<br>c<p>d</article><footer>f</footer>", "T\na b c\nd"),
        ("<body><div id=sidebar>s</div><div class='cookie-notice'>c</div><p>x<i>y</i>z</p><form>q</form><div class=comments><p>no</p></div>", "xyz"),
        ("<article><p>a</p><aside>s</aside><script>if (a<b) '</p>'</script><p>b</p><div class='advert'>buy</div></article><p>out", "a\nb"),
        ("<main><ul><li>one<li>two</ul></main><header>h</header>", "one\ntwo"),
        ("<article><p>cut off <b", "cut off"),
    ],
)
def test_main_text(html, text):
    assert htmlmain.main_text(html or "", None, None) == text


def test_wrapper_finds_the_template(spark):
    page = "<html><body><div><span>Site name</span></div><div><p>Story {0} is long.</p><p>More of {0}.</p></div><div>Call us now</div></body></html>"
    data = [(i, f"http://h.example/{i}", page.format(i)) for i in range(12)] + [(99, "odd", None), (99, None, "<p>alone"), (7, "http://h.example/7", page.format(7))]
    d = spark.createDataFrame([(*r, "clash") for r in data], "page_id long, url string, html string, host string")
    out = Counter((r["page_id"], r["text"], r["n_chars"]) for r in rows(htmlmain.extract(d)))
    for i in range(12):
        t = f"Story {i} is long.\nMore of {i}."
        assert out[i, t, len(t)] == 1 + (i == 7)
    assert out[99, "", 0] == 1 and out[99, "alone", 5] == 1
    assert rows(htmlmain.extract(d.where("1 = 0"))) == []


def test_clash_is_used():
    assert len(CLASH) > 10
