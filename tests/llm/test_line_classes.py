"""The character classes of the line dedup: exactly their sets, quick to search."""

from pyspark.sql import functions as F

from topicloom.llm import linededup

UNSPACED = [(0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


def test_line_classes_are_their_sets(spark):
    cp = spark.range(1, 0x110000, numPartitions=8).where("id < 55296 or id > 57343")
    char = F.substring(F.decode(F.unhex(F.concat(F.lit("00000078"), F.lpad(F.hex("id"), 8, "0"))), "UTF-32"), 2, 1)
    chars = cp.select("id", char.alias("c"))
    spaces = {r["id"] for r in chars.where(F.col("c").rlike(linededup.ANY_SPACE)).collect()}
    assert spaces == set(map(ord, linededup.SPACES)) and len(spaces) == 29
    wanted = F.lit(False)
    for a, b in UNSPACED:
        wanted = wanted | F.col("id").between(a, b)
    assert chars.where(F.col("c").rlike(linededup.UNSPACED) != wanted).isEmpty()
