"""DuckDB SQL oracles for the registered queries.

Each oracle is written independently of the Spark plan: dedup with
``row_number`` windows instead of ``min_by``; region tagging as a containment
join against the keyword table instead of a lookahead regex scan; boilerplate
removal with literal ``replace`` on a space-doubled string instead of ``\\b``
regexes (RE2 has no Unicode word boundary).  Only the regex *classes* are
shared text (``topicloom.functions.text``), because both dialects accept them.
"""

from __future__ import annotations

from topicloom.functions.fixed import (
    BANNER_MONTHS,
    BOILERPLATE_PHRASES,
    TOPIC_COLORS,
    TOPIC_STOP_WORDS,
)
from topicloom.functions.text import CLEAN_DROP_RE, DEDUP_NONALNUM_RE, EDGE_WS_RE, TOPIC_NONALPHA_RE, URL_RE, WS_RUN_RE
from topicloom.sources import dims
from topicloom.sources.testdata import HEADLINE_SUFFIXES


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def str_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


# ---------------------------------------------------------------- expressions


def clean_text(x: str) -> str:
    t = f"lower(coalesce({x}, ''))"
    t = rx(t, URL_RE, " ")
    t = rx(t, WS_RUN_RE, " ")
    t = rx(t, CLEAN_DROP_RE, "")
    return f"trim({t})"


def dedup_key(x: str) -> str:
    t = f"lower(coalesce({x}, ''))"
    t = rx(t, URL_RE, " ")
    t = rx(t, DEDUP_NONALNUM_RE, " ")
    t = rx(t, WS_RUN_RE, " ")
    return f"trim({t})"


def strip_ws(x: str) -> str:
    return rx(x, EDGE_WS_RE, "")


def topic_prepared(x: str) -> str:
    """SCL-02 up to the token split: the input is cleaned text, so the only
    non-word character is a space and a whole-word phrase is one bounded by
    spaces.  Doubling every space lets adjacent phrases each keep a boundary."""
    t = f"(' ' || replace(lower(coalesce({x}, '')), ' ', '  ') || ' ')"
    for phrase in BOILERPLATE_PHRASES:
        t = f"replace({t}, {q(' ' + phrase.replace(' ', '  ') + ' ')}, '   ')"
    t = rx(t, URL_RE, " ")
    t = rx(t, TOPIC_NONALPHA_RE, " ")
    return f"trim({rx(t, WS_RUN_RE, ' ')})"


def topic_tokens_from_prepared(p: str) -> str:
    return (
        f"list_filter(string_split({p}, ' '), lambda tok_: length(tok_) > 2 "
        f"AND NOT list_contains({str_list(TOPIC_STOP_WORDS)}, tok_))"
    )


def ordered_distinct(lst: str) -> str:
    return f"list_filter({lst}, lambda el_, pos_: list_position({lst}, el_) = pos_)"


def word_count(x: str) -> str:
    return f"CAST(len(list_filter(string_split({rx(x, WS_RUN_RE, ' ')}, ' '), lambda w_: w_ <> '')) AS INTEGER)"


def parse_published(x: str) -> str:
    s = f"trim(regexp_replace({x}, '^[A-Za-z]{{3}},\\s*', ''))"
    fmts = [
        f"try_strptime({s}, '%d %b %Y %H:%M:%S GMT')",
        f"try_strptime({s}, '%d %b %Y %H:%M:%S UTC')",
        f"try_strptime({s}, '%d %b %Y %H:%M:%S %z')",
        f"try_strptime({s}, '%Y-%m-%dT%H:%M:%SZ')",
        f"try_strptime({s}, '%Y-%m-%dT%H:%M:%S%z')",
        f"try_strptime({s}, '%Y-%m-%dT%H:%M:%S.%g%z')",
        f"try_strptime({s}, '%Y-%m-%d %H:%M:%S')",
        f"try_strptime({s}, '%Y-%m-%dT%H:%M:%S')",
    ]
    # normalise every candidate to epoch seconds (UTC) so offsets apply
    return "coalesce(" + ", ".join(f"epoch({f})" for f in fmts) + ")"


def banner_date(x: str) -> str:
    d = f"try_strptime({x}, '%Y-%m-%d')"
    months = str_list(BANNER_MONTHS)
    return (
        f"CASE WHEN {d} IS NULL THEN {x} ELSE lpad(CAST(day({d}) AS VARCHAR), 2, '0') || '.' || "
        f"{months}[month({d})] || '.' || CAST(year({d}) AS VARCHAR) END"
    )


# ---------------------------------------------------------------- tables


def keywords_values() -> str:
    rows = ", ".join(f"({p}, {q(r)}, {q(k)})" for p, r, k in dims.region_keyword_rows())
    return f"(VALUES {rows}) AS kw(priority, region, keyword)"


def coords_values(dashboard: bool = False) -> str:
    rows = ", ".join(f"({q(r)}, CAST({lat!r} AS DOUBLE), CAST({lon!r} AS DOUBLE))" for r, lat, lon in dims.region_coordinate_rows(dashboard))
    return f"(VALUES {rows}) AS c(region, lat, lon)"


def colors_values() -> str:
    rows = ", ".join(f"({i}, {q(h)})" for i, h in enumerate(TOPIC_COLORS))
    return f"(VALUES {rows}) AS tc(color_idx, hex)"


def articles_sql() -> str:
    keywords = [kw for _, _, kw in dims.region_keyword_rows()]
    keyword = f"' in ' || {str_list(keywords)}[(doc_id // 12) % {len(keywords)} + 1] || ' today'"
    suffix = "CASE doc_id % 12 " + " ".join(f"WHEN {k} THEN {q(v)}" for k, v in sorted(HEADLINE_SUFFIXES.items())) + f" WHEN 7 THEN {keyword} ELSE '' END"
    day = "lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0')"
    hour = "lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0')"
    return f"""
SELECT
  doc_id AS ord,
  CASE WHEN doc_id % 41 = 0 THEN NULL ELSE split_part(text, chr(10), 1) || {suffix} END AS headline,
  CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) END AS description,
  CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 10 = 1 THEN '  '
       ELSE 'https://' || source || '.example/' || CAST(doc_id % 700 AS VARCHAR) END AS url,
  CASE doc_id % 5
    WHEN 0 THEN '2024-01-' || {day} || 'T' || {hour} || ':00:00Z'
    WHEN 1 THEN 'Mon, ' || {day} || ' Jan 2024 ' || {hour} || ':30:00 GMT'
    WHEN 2 THEN 'Mon, ' || {day} || ' Jan 2024 ' || {hour} || ':30:00 +0200'
    WHEN 3 THEN 'not a date' END AS published_at,
  source AS source_name,
  'section' || CAST(doc_id % 6 AS VARCHAR) AS source_section,
  CASE lang WHEN 'de' THEN 'Germany' WHEN 'fr' THEN 'France' WHEN 'es' THEN 'Spain' ELSE 'United Kingdom' END AS country,
  lang AS language,
  '2024-01-' || {day} AS ds
FROM documents"""


def cleaned_ctes(scope: str = "", dedup: bool = True) -> str:
    """CTEs ``articles`` -> ``deduped`` -> ``cleaned`` (FLT-01/02, DDP-03/04, SCL-01);
    ``scope`` adds partition keys (e.g. ``ds, ``) so each file is deduplicated alone."""
    return f"""
articles AS ({articles_sql()}),
keyed AS (
  SELECT * REPLACE (coalesce(description, '') AS description),
         {strip_ws("coalesce(url, '')")} AS url_key,
         {dedup_key("headline")} AS hkey
  FROM articles WHERE headline IS NOT NULL),
url_pass AS (
  SELECT * FROM keyed WHERE url_key <> ''
  QUALIFY row_number() OVER (PARTITION BY {scope}url_key ORDER BY ord) = 1
  UNION ALL
  SELECT * FROM keyed WHERE url_key = ''),
deduped AS (
  SELECT * EXCLUDE (url_key, hkey) FROM {"url_pass" if dedup else "keyed"}
  {"QUALIFY row_number() OVER (PARTITION BY " + scope + "hkey ORDER BY (url_key <> '') DESC, ord) = 1" if dedup else ""}),
cleaned AS (
  SELECT *, {clean_text("headline")} AS headline_clean, {clean_text("description")} AS description_clean
  FROM deduped)"""


def processed_ctes(dedup: bool = True, scope: str = "") -> str:
    """``processed``: cleaned + text/time features, region, coordinates, topic text
    (``dedup=False``: every non-null headline, as the streaming preprocess emits)."""
    ts = parse_published("published_at")
    topic_in = "coalesce(headline_clean, '') || ' ' || coalesce(description_clean, '')"
    return f"""{cleaned_ctes(scope, dedup)},
region_hits AS (
  SELECT c.ord, min(kw.priority) AS p
  FROM cleaned c JOIN {keywords_values()}
    ON contains(' ' || lower(concat_ws(' ', c.headline, c.description)) || ' ', ' ' || kw.keyword || ' ')
  GROUP BY c.ord),
region_names AS (SELECT priority, any_value(region) AS region FROM {keywords_values()} GROUP BY priority),
topic_prep AS (
  SELECT ord, {topic_tokens_from_prepared(topic_prepared(topic_in))} AS toks FROM cleaned),
processed0 AS (
  SELECT c.*,
    CAST(length(headline_clean) AS INTEGER) AS headline_length,
    {word_count("headline_clean")} AS headline_word_count,
    CAST(length(description_clean) AS INTEGER) AS description_length,
    {word_count("description_clean")} AS description_word_count,
    {ts} AS published_epoch,
    coalesce(rn.region, 'World') AS region,
    array_to_string({ordered_distinct("tp.toks")}, ' ') AS topic_text
  FROM cleaned c
  LEFT JOIN region_hits rh ON rh.ord = c.ord
  LEFT JOIN region_names rn ON rn.priority = rh.p
  JOIN topic_prep tp ON tp.ord = c.ord),
processed AS (
  SELECT p.*, coalesce(c.lat, 0.0) AS lat, coalesce(c.lon, 0.0) AS lon
  FROM processed0 p LEFT JOIN {coords_values()} ON c.region = p.region)"""


def feeds_sql() -> str:
    n = "CAST(substr(source, 4, 10) AS INTEGER)"
    return f"""SELECT source AS feed_key,
  CASE WHEN {n} % 4 = 0 THEN NULL ELSE 'Feed ' || CAST({n} AS VARCHAR) END AS source_name,
  CASE WHEN {n} % 8 = 0 THEN NULL ELSE 'name' || CAST({n} AS VARCHAR) END AS name,
  CASE WHEN {n} % 3 = 0 THEN NULL ELSE 'section' || CAST({n} % 3 AS VARCHAR) END AS source_section,
  CASE WHEN {n} % 6 = 0 THEN NULL ELSE 'category' || CAST({n} % 2 AS VARCHAR) END AS category,
  CASE WHEN {n} % 5 = 0 THEN NULL ELSE 'country' || CAST({n} % 5 AS VARCHAR) END AS country,
  CASE WHEN {n} % 7 = 0 THEN NULL ELSE 'lang' || CAST({n} % 7 AS VARCHAR) END AS language,
  'api' || CAST({n} AS VARCHAR) AS api_section
FROM (SELECT DISTINCT source FROM documents)"""


def feed_labels_sql() -> str:
    return """SELECT feed_key, coalesce(source_name, name, 'unknown') AS source_name,
  coalesce(source_section, category, 'unknown') AS source_section,
  coalesce(country, 'unknown') AS country, coalesce(language, 'unknown') AS language,
  coalesce(source_name, name, 'unknown') || '/' || coalesce(source_section, category, 'unknown') AS label
FROM feeds"""


def rss_items_sql() -> str:
    rest = "CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) END"
    return f"""SELECT doc_id AS ord, source AS feed_key, split_part(text, chr(10), 1) AS title,
  'https://' || source || '.example/' || CAST(doc_id AS VARCHAR) AS link,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE {rest} END AS description,
  CASE WHEN doc_id % 4 = 0 THEN {rest} END AS summary,
  CASE WHEN doc_id % 9 = 0 THEN NULL ELSE '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || 'T06:00:00Z' END AS published,
  '2024-02-01T00:00:00Z' AS updated
FROM documents"""


def api_results_sql() -> str:
    rest = "CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) END"
    return f"""SELECT doc_id AS ord, source AS feed_key, split_part(text, chr(10), 1) || ' - ' || source AS webTitle,
  'https://api.example/' || source || '/' || CAST(doc_id AS VARCHAR) AS webUrl,
  '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || 'T' || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':15:00Z' AS webPublicationDate,
  CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 11 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS f_headline,
  CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 5 = 0 THEN NULL ELSE {rest} END AS f_trail,
  {rest} AS f_body
FROM documents"""
