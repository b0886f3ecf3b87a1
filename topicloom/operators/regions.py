"""Region tagging and coordinates (JON-01..03).

JON-01 semantics: a keyword matches when ``" kw "`` occurs in
``" " + lower(headline + " " + description) + " "`` (only U+0020 delimits, so
punctuation blocks a match); the first region in dictionary order with any
matching keyword wins, else ``World``.

Plan: one regex pass per row, no explode, no shuffle, no join back.  The
pattern `` (?=(...) )`` holds all keywords as a trie inside a zero-width
lookahead, so the scan stops at every space and reports a keyword starting
there (overlapping keywords such as "south africa" / "africa" are all seen,
since only the leading space is consumed).  Where two keywords start at the
same space one is a whole-word prefix of the other; the shorter one is
reported, which is the higher- or equal-priority one (checked when the
pattern is built).  The smallest priority among the reported keywords is the
answer.  Cost is linear in text length; whole texts are scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.functions.fixed import DEFAULT_REGION
from topicloom.functions.text import region_text
from topicloom.sources import dims


def _priority_map(rows) -> Column:
    args = []
    for priority, _, kw in rows:
        args.extend([F.lit(kw), F.lit(priority)])
    return F.create_map(*args)


def _region_names(rows) -> Column:
    names, seen = [], set()
    for _, region, _ in rows:
        if region not in seen:
            seen.add(region)
            names.append(region)
    return F.array(*[F.lit(n) for n in names])


def _esc(ch: str) -> str:
    return ch if ch.isalnum() else "\\" + ch


#: Alternatives of a trie node that are tried in turn.
GROUP = 5


def _trie_regex(words: list[str]) -> str:
    """Alternation shaped as a trie: at each node "the keyword ends here" is tried
    before longer continuations, so the shortest keyword starting at a position
    is reported and each position costs about one character comparison.  A wide node is
    cut into groups that one look-up of the next character leaves or enters."""
    trie: dict = {}
    for w in words:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def rx(node: dict) -> str:
        ends = [""] if "" in node else []
        alts = [(_esc(ch), _esc(ch) + rx(child)) for ch, child in sorted(node.items()) if ch != ""]
        if len(ends) + len(alts) == 1:
            return ends[0] if ends else alts[0][1]
        groups = [alts[i : i + GROUP] for i in range(0, len(alts), GROUP)]
        if len(groups) > 1:
            tails = ["(?=[" + "".join(ch for ch, _ in g) + "])(?:" + "|".join(a for _, a in g) + ")" for g in groups]
        else:
            tails = [a for _, a in alts]
        return "(?:" + "|".join(ends + tails) + ")"

    return rx(trie)


def keyword_pattern(rows) -> str:
    """`` (?=(kw...) )``: at every space, the shortest keyword that starts there.

    Shortest-first is the priority rule as long as no keyword is a whole-word
    prefix of a keyword of a *higher-priority* region; that is checked here."""
    prio = {kw: p for p, _, kw in rows}
    for a in prio:
        for b in prio:
            if b.startswith(a + " ") and prio[a] > prio[b]:
                raise ValueError(f"keyword {a!r} shadows higher-priority {b!r}; trie order would be wrong")
    return " (?=(" + _trie_regex(list(prio)) + ") )"


def keyword_hits(text: Column) -> Column:
    """Keywords that occur space-delimited in ``text`` (one per start position)."""
    rows = dims.region_keyword_rows()
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    return F.regexp_extract_all(padded, F.lit(keyword_pattern(rows)), 1)


def region_priority(text: Column) -> Column:
    """Smallest region priority whose keyword occurs space-delimited in ``text`` (NULL if none)."""
    prio = _priority_map(dims.region_keyword_rows())
    hits = F.array_distinct(keyword_hits(text))  # long texts repeat keywords; look each up once
    return F.array_min(F.transform(hits, lambda k: F.element_at(prio, k)))


def region_of(headline: Column | str, description: Column | str) -> Column:
    """JON-01 as a column expression."""
    rows = dims.region_keyword_rows()
    p = region_priority(region_text(headline, description))
    # the priority is named once: a CASE on it would search the text for each mention
    return F.coalesce(F.get(_region_names(rows), p), F.lit(DEFAULT_REGION))


def tag_regions(df: DataFrame, headline: str = "headline", description: str = "description") -> DataFrame:
    """JON-01 + JON-02: adds ``region``, ``lat``, ``lon`` (pipeline coordinate table)."""
    tagged = df.withColumn("region", region_of(headline, description))
    return add_coordinates(tagged, dashboard=False)


def add_coordinates(df: DataFrame, dashboard: bool = False) -> DataFrame:
    """JON-02 / JON-03: broadcast left join to a coordinate table, World as default.

    ``dashboard=True`` is the dashboard re-geocoding: NULL region -> World and
    the 10-row table overwrites any lat/lon already present."""
    spark = df.sparkSession
    coords = dims.region_coordinates(spark, dashboard=dashboard)
    default = {r: (lat, lon) for r, lat, lon in dims.region_coordinate_rows(dashboard)}[DEFAULT_REGION]
    base = df.drop("lat", "lon")
    if dashboard:
        base = base.withColumn("region", F.coalesce(F.col("region").cast("string"), F.lit(DEFAULT_REGION)))
    c = coords.select(F.col("region").alias("_coord_region"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    joined = base.join(F.broadcast(c), base["region"] == c["_coord_region"], "left")
    return (
        joined.withColumn("lat", F.coalesce(F.col("_lat"), F.lit(default[0])))
        .withColumn("lon", F.coalesce(F.col("_lon"), F.lit(default[1])))
        .drop("_coord_region", "_lat", "_lon")
    )
