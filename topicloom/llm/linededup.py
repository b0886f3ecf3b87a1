"""Operator 10: repeated line runs by distributed prefix doubling (DataFrame only).

Every document is a sequence of line ids.  Prefix doubling ranks the runs of 1, 2, 4, ...
lines that start at each line: the pairs (rank of 2^j lines here, rank of 2^j lines 2^j
further on) are sorted by range over the cluster, and their places in that order are
the ranks of 2^(j+1) lines.  Equal ranks are equal runs, an interval of the suffix order
whose common prefix has that length.  Only runs that occur twice or more are ranked:
a line whose run is alone takes no part in the next level.

A run of any length n is an interval (n, rank of its first 2^k lines, rank of its last
2^k lines) with the largest power of two that fits.  The first member of an interval in
(doc_id, text hash, line) order is the original, the others are later copies -- but for
copies that overlap their original, as in a line repeated over and over: those stand
nowhere else in full, and stay.

A maximal repeated run counts if it has ``min_words`` words or more, a line counting
as one word at least.  Words stand between white space; in scripts written without
spaces, every two characters count as a word.  Such a run is exactly the union of the shortest runs of
``min_words`` that start, or end, at its lines; so these two runs of each line, at
most ``min_words`` lines long, are all that has to be looked up: the levels needed do
not grow with the corpus.  The later copies' lines are deleted.

Lines are compared by 128 bits, runs by exact ranks.  Line counts and intervals are
aggregated before they join back; a hot line's or run's left side can be split by the
skew join, as its right side has one row.  The window functions are over one
document's lines.

Defined results: a null text stays null and has no lines; an empty text is one empty
line; lines compare with white space trimmed and its runs taken as one space, carriage
returns and no-break spaces included; rows equal in doc_id and text are one
document here and stay as often as they come, treated alike; a document that loses
all its lines keeps an empty text; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.llm.common import land

MIN_WORDS = 50

#: White space but the line feed: Unicode's, the zero-width space and the byte order mark.
NARROW_SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
WIDE_SPACES = "            ​    　﻿"
SPACES = NARROW_SPACES + WIDE_SPACES
#: Any of them.  The narrow ones are a table look-up; nearly all else fails one range test.
ANY_SPACE = rf"[{NARROW_SPACES}[\x{{1680}}-\x{{FEFF}}&&[{WIDE_SPACES}]]]"
#: Scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana, Han (behind one range test).
UNSPACED = (
    r"[\x{0E00}-\x{3FFFF}&&[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3005}-\x{3007}\x{3040}-\x{30FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]]"
)

DOC = ["_d", "_h"]


def line_rows(docs: DataFrame) -> DataFrame:
    """(_d, _h, pos, l1, l2, weight): the lines of every distinct (doc_id, text)."""
    # Most texts hold no white space but spaces and line feeds: the rest is translated.
    text = F.when(F.col("text").rlike(ANY_SPACE), F.translate("text", SPACES, " " * len(SPACES))).otherwise(F.col("text"))
    exploded = docs.select(F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_h"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "_l"))
    line = F.when(F.contains("_l", F.lit("  ")), F.regexp_replace("_l", " {2,}", " ")).otherwise(F.col("_l"))
    line = F.trim(line)
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" ")))
    unspaced = F.when(F.octet_length(line) > F.char_length(line), F.regexp_count(line, F.lit(f"{UNSPACED}{{2}}"))).otherwise(0)
    words = spaces + unspaced + 1
    # The hash of a first value seeds that of the next: the two differ in their seed.
    ids = [F.xxhash64(line).alias("l1"), F.xxhash64(F.lit("line"), line).alias("l2")]
    rows = exploded.select(*DOC, "pos", *ids, words.cast("long").alias("weight"))
    return rows.repartition(*DOC).dropDuplicates([*DOC, "pos"])


def shared_ranks(rows: DataFrame, cols: list[str]) -> DataFrame:
    """(cols, rank): the values that two rows or more have, and their places in sorted order."""
    shared = rows.groupBy(*cols).agg(F.count("*").alias("m")).where("m > 1").select(*cols)
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    sorted_ = shared.repartitionByRange(*cols).sortWithinPartitions(*cols)
    placed = land(sorted_.withColumn("part", F.spark_partition_id()).withColumn("at", at), "line-sorted")
    sizes = placed.groupBy("part").agg(F.count("*").alias("m"))  # a row a partition
    offsets = sizes.select("part", (F.sum("m").over(Window.orderBy("part")) - F.col("m")).alias("before"))
    return placed.join(offsets, "part").select(*cols, (F.col("at") + F.col("before")).alias("rank"))


def doubled(lines: DataFrame, min_words: int) -> DataFrame:
    """(_d, _h, pos, j, rank): ranks of the runs of 2^j lines that occur twice or more, as far
    as ``min_words`` lines reach."""
    level = land(lines.join(shared_ranks(lines, ["l1", "l2"]), ["l1", "l2"]).select(*DOC, "pos", "rank"), "line-ranks-0")
    out = level.withColumn("j", F.lit(0))
    for j in range(1, max(1, min_words.bit_length())):
        half = 1 << j - 1
        there = Window.partitionBy(*DOC).orderBy("pos").rangeBetween(half, half)
        pairs = level.withColumnRenamed("rank", "a").withColumn("b", F.max("a").over(there)).where("b is not null")
        level = land(pairs.join(shared_ranks(pairs, ["a", "b"]), ["a", "b"]).select(*DOC, "pos", "rank"), f"line-ranks-{j}")
        out = out.unionByName(level.withColumn("j", F.lit(j)))
    return out


def runs(lines: DataFrame, ranks: DataFrame, min_words: int) -> DataFrame:
    """(_d, _h, start, n, a, b): the shortest runs of ``min_words`` from and up to each line,
    where their first and last parts occur elsewhere."""
    by_pos = Window.partitionBy(*DOC).orderBy("pos")
    df = lines.withColumn("upto", F.sum("weight").over(by_pos.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("before", F.col("upto") - F.col("weight"))
    # From a line: it and the lines that begin within the next min_words - 1 words.
    ahead = Window.partitionBy(*DOC).orderBy("before").rangeBetween(0, min_words - 1)
    # Up to a line: as many lines end min_words before its end as come before the run.
    behind = Window.partitionBy(*DOC).orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    df = df.withColumn("n_from", F.count("*").over(ahead).cast("int")).withColumn("end_from", F.max("upto").over(ahead))
    df = df.withColumn("start_to", F.count("*").over(behind).cast("int"))
    first = F.when(F.col("end_from") - F.col("before") >= min_words, F.struct(F.col("pos").alias("start"), F.col("n_from").alias("n")))
    second = F.when(F.col("upto") >= min_words, F.struct(F.col("start_to").alias("start"), (F.col("pos") - F.col("start_to") + 1).alias("n")))
    both = df.select(*DOC, F.explode(F.array_distinct(F.array_compact(F.array(first, second)))).alias("r")).select(*DOC, "r.start", "r.n")
    both = both.dropDuplicates([*DOC, "start", "n"]).withColumn("j", F.floor(F.log2("n")).cast("int"))
    both = both.withColumn("second_at", (F.col("start") + F.col("n") - F.expr("shiftleft(1, j)")).cast("int"))
    whole = _at(both, ranks, "start", "a")
    return _at(whole, ranks, "second_at", "b").select(*DOC, "start", "n", "a", "b")


def _at(df: DataFrame, ranks: DataFrame, pos: str, out: str) -> DataFrame:
    """Add the rank of level j at line ``pos``; rows without one go."""
    r = ranks.select(F.col("_d").alias("_rd"), F.col("_h").alias("_rh"), F.col("pos").alias("_rp"), F.col("j").alias("_rj"), F.col("rank").alias(out))
    on = F.col("_d").eqNullSafe(F.col("_rd")) & (F.col("_h") == F.col("_rh")) & (F.col(pos) == F.col("_rp")) & (F.col("j") == F.col("_rj"))
    return df.join(r, on).drop("_rd", "_rh", "_rp", "_rj")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lines, later copies of an earlier run as (_d, _h, start, n))."""
    lines = land(line_rows(docs), "line-rows")
    named = land(runs(lines, doubled(lines, min_words), min_words), "line-runs")
    first = named.groupBy("n", "a", "b").agg(F.min(F.struct("_d", "_h", "start")).alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    same_doc = F.col("_d").eqNullSafe(F.col("first._d")) & (F.col("_h") == F.col("first._h"))
    overlaps = same_doc & (F.col("start") < F.col("first.start") + F.col("n"))  # or is the original itself
    return lines, named.join(first, ["n", "a", "b"]).where(~overlaps).select(*DOC, "start", "n")


def kept_runs(lines: DataFrame, later: DataFrame) -> DataFrame:
    """For documents that lose lines: n_lines, n_deleted and the runs of kept lines."""
    marks = lines.select(*DOC, "pos", F.lit(None).cast("int").alias("end")).unionByName(
        later.select(*DOC, F.col("start").alias("pos"), (F.col("start") + F.col("n")).cast("int").alias("end"))
    )
    by_doc = Window.partitionBy(*DOC)
    by_pos = by_doc.orderBy("pos")
    per_line = marks.repartition(*DOC).groupBy(*DOC, "pos").agg(F.max("end").alias("end"))
    flags = (
        per_line.withColumn("hit", F.max("end").over(by_doc))
        .where("hit is not null")
        .withColumn("gone", F.coalesce(F.max("end").over(by_pos.rowsBetween(Window.unboundedPreceding, 0)) > F.col("pos"), F.lit(False)))
    )
    island = F.col("pos") - F.row_number().over(Window.partitionBy(*DOC, "gone").orderBy("pos"))
    spans = flags.withColumn("island", island).groupBy(*DOC, "gone", "island").agg(F.min("pos").alias("at"), F.count("*").cast("int").alias("n"))
    return spans.groupBy(*DOC).agg(
        F.sort_array(F.collect_list(F.when(~F.col("gone"), F.struct("at", "n")))).alias("_kept"),
        F.sum("n").cast("long").alias("n_lines"),
        F.sum(F.when(F.col("gone"), F.col("n")).otherwise(0)).cast("long").alias("n_deleted"),
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated runs deleted from text, and the columns
    n_lines and n_deleted (which replace columns of these names)."""
    cols = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    lines, later = repeats(docs.select("doc_id", "text"), min_words)
    kept = kept_runs(lines, later).select(F.col("_d").alias("__ld_kd"), F.col("_h").alias("__ld_kh"), F.col("_kept").alias("__ld_kept"), F.col("n_lines").alias("__ld_n"), F.col("n_deleted").alias("__ld_g"))
    rows = docs.select(*cols, F.xxhash64("text").alias("__ld_th"))
    joined = rows.join(kept, rows["doc_id"].eqNullSafe(F.col("__ld_kd")) & (F.col("__ld_th") == F.col("__ld_kh")), "left")
    all_lines = F.split("text", "\n", -1)
    text = F.array_join(F.flatten(F.transform("__ld_kept", lambda r: F.slice(all_lines, r["at"] + 1, r["n"]))), "\n")
    return joined.withColumns(
        {
            "n_lines": F.coalesce("__ld_n", F.size(all_lines).cast("long"), F.lit(0).cast("long")),
            "n_deleted": F.coalesce("__ld_g", F.lit(0).cast("long")),
            "text": F.when(F.col("__ld_kept").isNull(), F.col("text")).otherwise(text),
        }
    ).select(*cols, "n_lines", "n_deleted")
