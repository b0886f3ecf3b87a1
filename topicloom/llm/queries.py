"""The registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import bpe, decontam, htmlmain, jaccard, linededup, merkle, minhash, periods, pii, sharding, toxicity, vptree, warc
from topicloom.llm.common import table
from topicloom.session import ship_package

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return deco


@register("op1_prefix_bpe")
def op1(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS f FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN f IS NULL OR f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f <> page_id THEN f END AS refers_to
FROM f
"""


@register("op2_warc_bundles", OP2_SQL)
def op2(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@register("op3_wrapper_text")
def op3(spark, sf_dir):
    return htmlmain.extract(table(spark, sf_dir, "pages"))


@register("op4_bounded_ring")
def op4(spark, sf_dir):
    out = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP5_SQL = """
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dwin.n, i, item FROM dwin JOIN win USING (s) WHERE dwin.n = win.n),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)),
np AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN np USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@register("op5_automaton_decontam", OP5_SQL)
def op5(spark, sf_dir):
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op6_feistel_pii")
def op6(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_found")


@register("op7_vantage_trees")
def op7(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.search(vectors, vectors.where("vec_id % 50 = 0"))


OP8_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""


@register("op8_prefix_tree_join", OP8_SQL)
def op8(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@register("op9_weak_toxicity")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op10_line_runs")
def op10(spark, sf_dir):
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Lower-case A-Z only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11_SQL = """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, list_transform(
    [[CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text], [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')]],
    lambda v: sha256(array_to_string(list_transform(v, lambda x: CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END), ''))) AS h
  FROM documents),
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, x: xor(c >> 1, 3988292384 * (c & 1)), CAST(i AS BIGINT))) AS t),
leaf AS (
  SELECT doc_id, lang, h[1] AS leaf,
         CASE WHEN xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT)),
              lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 3 = 0 THEN h[2] ELSE h[1] END AS shown,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i
  FROM f, crc),
node(lvl, lang, i, h, n) AS (
  SELECT 0, lang, i, leaf, count(*) OVER (PARTITION BY lang) FROM leaf
  UNION ALL
  SELECT lvl + 1, lang, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY lvl, lang, i // 8, n),
top AS (SELECT lang, lvl AS height, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i FROM node WHERE n = 1),
tnode(lvl, i, h, n) AS (
  SELECT 0, i, h, count(*) OVER () FROM top
  UNION ALL
  SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM tnode WHERE n > 1 GROUP BY lvl, i // 8, n),
every AS (
  SELECT lvl, lang, i, h, n, 'rows' AS part FROM node WHERE n > 1
  UNION ALL SELECT tnode.lvl + top.height, top.lang, tnode.i, tnode.h, tnode.n, 'groups' FROM tnode, top WHERE tnode.n > 1),
own(doc_id, lang, lvl, i, j, h, ti) AS (
  SELECT doc_id, leaf.lang, 0, leaf.i, CASE WHEN height = 0 THEN top.i ELSE leaf.i END, shown, top.i FROM leaf JOIN top ON leaf.lang IS NOT DISTINCT FROM top.lang
  UNION ALL
  SELECT o.doc_id, o.lang, o.lvl + 1, any_value(o.i), CASE WHEN o.lvl + 1 = any_value(top.height) THEN any_value(o.ti) ELSE o.j // 8 END,
         sha256(string_agg(CASE WHEN e.i = o.j THEN o.h ELSE e.h END, '' ORDER BY e.i)), any_value(o.ti)
  FROM own o JOIN every e ON e.lvl = o.lvl AND e.lang IS NOT DISTINCT FROM o.lang AND e.i // 8 = o.j // 8
  JOIN top ON top.lang IS NOT DISTINCT FROM o.lang GROUP BY o.doc_id, o.lang, o.lvl, o.j),
proof AS (
  SELECT o.doc_id, sha256(coalesce(string_agg(e.h, '' ORDER BY e.lvl, e.i), '')) AS p
  FROM own o LEFT JOIN every e ON e.lvl = o.lvl AND e.lang IS NOT DISTINCT FROM o.lang AND e.i // 8 = o.j // 8 AND e.i <> o.j GROUP BY o.doc_id),
last AS (SELECT doc_id, arg_max(h, lvl) AS folded FROM own GROUP BY doc_id)
SELECT leaf.doc_id, leaf.leaf, top.h AS subroot, r.h AS root, proof.p AS proof_sha256, folded AS folded_root, folded = r.h AS verified
FROM leaf JOIN top ON leaf.lang IS NOT DISTINCT FROM top.lang JOIN proof USING (doc_id) JOIN last USING (doc_id) CROSS JOIN (SELECT h FROM tnode WHERE n = 1) r
"""


@register("op11_merkle_manifest", OP11_SQL)
def op11(spark, sf_dir):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return merkle.proofs(table(spark, sf_dir, "documents"), tampered)


OP12_SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, x: xor(c >> 1, 3988292384 * (c & 1)), CAST(i AS BIGINT))) AS t),
w0 AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
       xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT)),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM documents, crc),
w1 AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM w0),
w2 AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM w1),
w3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM w2),
pos AS (SELECT doc_id, n, i, CASE WHEN a IS NULL OR i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END AS x
        FROM (SELECT *, unnest(range(n)) AS i FROM w3)),
same AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM pos a JOIN pos b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 3 * (b.i - a.i) <= a.n),
isl AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM same),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM isl GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(24, 3 * q)),
run AS (SELECT doc_id, s, len, min(q) AS q FROM stretch GROUP BY doc_id, s, len),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM run GROUP BY doc_id),
top AS (SELECT r.* FROM run r WHERE NOT EXISTS (SELECT 1 FROM run o WHERE o.doc_id = r.doc_id AND
        (o.len * r.q > r.len * o.q OR (o.len * r.q = r.len * o.q AND (o.s < r.s OR (o.s = r.s AND o.q < r.q)))))),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS body FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w0.doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.len AS length, top.q AS period, 1000 * top.len // top.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM w0 LEFT JOIN listed USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@register("op12_periodic_runs", OP12_SQL)
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periods.planted(F.col("text"), F.col("doc_id")).alias("text"))
    return periods.report(docs).drop("collapsed")


OP13_SQL = (
    OP8_SQL.replace("list_slice(w, i, i + 4)", "list_slice(w, i, i + 2)")
    .replace("greatest(len(w) - 4, 1)", "greatest(len(w) - 2, 1)")
    .replace("100 * i >= 75 * (", "100 * i >= 85 * (")
    .replace("AS component_id", "AS component_id, doc_id = least(doc_id, coalesce(m, doc_id)) AS kept")
)


@register("op13_bbit_minhash", OP13_SQL)
def op13(spark, sf_dir):
    return minhash.near_copies(table(spark, sf_dir, "documents"))


@register("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
