"""String column functions (SCL-01..10, DDP-06).

Every function maps Column -> Column with built-in expressions only, so the
whole cleaning chain stays inside whole-stage codegen (no Python per row).

Regex dialect: the cleaning rules were written against Python's ``re`` where
``\\s`` is the Unicode whitespace set.  Java's ``\\s`` is ASCII only, so the set
is spelled out explicitly (``WS``); the same class text is valid in RE2, which
lets the SQL oracles reuse it verbatim.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicloom.functions.fixed import BOILERPLATE_PHRASES, CLEAN_EXTRA_LETTERS, TOPIC_STOP_WORDS

# Python str whitespace: \t \n \v \f \r, U+001C-001F, space, U+0085, U+00A0,
# U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000.
WS = (
    r"\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
URL_RE = rf"(?:http|www)[^{WS}]+"
WS_RUN_RE = rf"[{WS}]+"
# Same effect as replacing WS_RUN_RE with one space, but a lone space (already
# collapsed) is not matched, so ordinary text produces almost no replacements.
WS_NOSPACE = WS.replace(" ", "")
WS_COLLAPSE_RE = rf"[{WS_NOSPACE}][{WS}]*| [{WS}]+"
EDGE_WS_RE = rf"^[{WS}]+|[{WS}]+$"
CLEAN_DROP_RE = rf"[^a-zA-Z0-9{CLEAN_EXTRA_LETTERS}{WS}]"
TOPIC_NONALPHA_RE = rf"[^a-zA-Z{WS}]"
DEDUP_NONALNUM_RE = rf"[^a-zA-Z0-9{WS}]"

# The same classes as Spark runs them.  Java tries the ranges of a class one after the other
# for every character, but looks up Latin-1 characters that are listed one by one in a table:
# here ASCII costs one look-up, and the wide white space is behind one range test.  Runs are
# matched whole where what replaces them is nothing or is collapsed afterwards.
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NARROW_WS = r"\t\n\x{0b}\f\r\x{1c}\x{1d}\x{1e}\x{1f}\x{85}\x{a0}"
_WIDE_WS = r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
_WS = rf" {_NARROW_WS}{_WIDE_WS}"
_URL = rf"(?=[hw])(?:http|www)[^{_WS}]+"
_WS_COLLAPSE = rf"[{_WS}](?:[{_WS}]+|(?<! ))"
_EDGE_WS = rf"^[{_WS}]+|[{_WS}]+$"
_CLEAN_DROP = rf"[^{_LETTERS}0123456789{CLEAN_EXTRA_LETTERS}{_WS}]+"
_TOPIC_NONALPHA = rf"[^{_LETTERS}{_WS}]+"
_DEDUP_NONALNUM = rf"[^{_LETTERS}0123456789{_WS}]+"
# Blanking a class and collapsing white space afterwards, in one pass: every run of either but
# a lone space, which stays as it is.
_TOPIC_GAPS = rf"[^{_LETTERS}](?:[^{_LETTERS}]+|(?<! ))"
_DEDUP_GAPS = rf"[^{_LETTERS}0123456789](?:[^{_LETTERS}0123456789]+|(?<! ))"
# One pass for all boilerplate phrases.  Same result as replacing them one by
# one in list order: the only phrases that can overlap ("skip advertisement" /
# "advertisement", "follow live" / "live updates") leave nothing but topic stop
# words behind either way.
BOILERPLATE_RE = r"(?U)\b(?:" + "|".join(BOILERPLATE_PHRASES) + r")\b"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), _EDGE_WS, "")


def clean_text(col: Column | str) -> Column:
    """SCL-01: lower, drop URLs, collapse whitespace, then delete characters
    outside letters/digits/umlauts.  Deleting after collapsing keeps the double
    spaces and glued words of the original rule (``"a – b"`` -> ``"a  b"``)."""
    t = F.lower(F.coalesce(_c(col), F.lit("")))
    t = F.regexp_replace(t, _URL, " ")
    t = F.regexp_replace(t, _WS_COLLAPSE, " ")
    t = F.regexp_replace(t, _CLEAN_DROP, "")
    return F.trim(t)


def dedup_key(col: Column | str) -> Column:
    """SCL-03: near-duplicate headline key (lower, no URLs, punctuation to spaces)."""
    t = F.lower(F.coalesce(_c(col), F.lit("")))
    t = F.regexp_replace(t, _URL, " ")
    return F.trim(F.regexp_replace(t, _DEDUP_GAPS, " "))


def distinct_tokens(tokens: Column) -> Column:
    """DDP-06 on an array: order-preserving distinct (first occurrence kept)."""
    return F.array_distinct(tokens)


def dedup_tokens(col: Column | str) -> Column:
    """DDP-06: order-preserving distinct of whitespace tokens."""
    toks = F.filter(F.split(F.trim(F.regexp_replace(_c(col), _WS_COLLAPSE, " ")), " "), lambda t: t != "")
    return F.array_join(distinct_tokens(toks), " ")


def topic_tokens(col: Column | str) -> Column:
    """SCL-02 as an array: boilerplate out, URLs out, non-letters to spaces,
    topic stop words and tokens of length <= 2 dropped, first occurrence kept."""
    t = F.lower(F.coalesce(_c(col), F.lit("")))
    t = F.regexp_replace(t, BOILERPLATE_RE, " ")
    t = F.regexp_replace(t, _URL, " ")
    t = F.trim(F.regexp_replace(t, _TOPIC_GAPS, " "))
    stop = F.array(*[F.lit(w) for w in TOPIC_STOP_WORDS])
    # array_except = order-preserving distinct minus the stop words (hash based);
    # filtering by length after deduplicating gives the same tokens in the same order
    return F.filter(F.array_except(F.split(t, " "), stop), lambda x: F.length(x) > 2)


def clean_topic_text(col: Column | str) -> Column:
    """SCL-02: topic text string (tokens joined by one space)."""
    return F.array_join(topic_tokens(col), " ")


def topic_text(headline_clean: Column | str, description_clean: Column | str) -> Column:
    """SCL-08: ``headline_clean + " " + description_clean`` (nulls as "") -> SCL-02."""
    combined = F.concat(
        F.coalesce(_c(headline_clean), F.lit("")), F.lit(" "), F.coalesce(_c(description_clean), F.lit(""))
    )
    return clean_topic_text(combined)


def word_count(col: Column | str) -> Column:
    """SCL-05: number of whitespace-separated words; "" -> 0."""
    return F.size(F.regexp_extract_all(_c(col), F.lit(rf"[^{_WS}]+"), F.lit(0)))


def text_features(df, headline_clean: str = "headline_clean", description_clean: str = "description_clean"):
    """SCL-05 columns: code-point lengths and word counts of the cleaned texts."""
    return (
        df.withColumn("headline_length", F.length(headline_clean))
        .withColumn("headline_word_count", word_count(headline_clean))
        .withColumn("description_length", F.length(description_clean))
        .withColumn("description_word_count", word_count(description_clean))
    )


def region_text(headline: Column | str, description: Column | str) -> Column:
    """SCL-06: present strings joined by one space, lower-cased, punctuation kept."""
    return F.lower(F.concat_ws(" ", _c(headline), _c(description)))


def contains_keyword(text: Column, keyword: Column | str) -> Column:
    """SCL-07: space-delimited containment (only U+0020 delimits)."""
    kw = F.lit(keyword) if isinstance(keyword, str) else keyword
    return F.instr(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), kw, F.lit(" "))) > 0


def keywords_display(keywords: Column | str) -> Column:
    """SCL-09: keyword array -> ``"a, b, c"``."""
    return F.array_join(_c(keywords), ", ")


def date_from_path(path: Column | str) -> Column:
    """SCL-10: the ``YYYY-MM-DD`` part of a dated file name ("" if none)."""
    return F.regexp_extract(_c(path), r"(\d{4}-\d{2}-\d{2})", 1)
