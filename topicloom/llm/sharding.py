"""Operator 4: consistent-hash ring with virtual nodes and bounded loads (DataFrame only).

The ring has ``2 ** ring_bits`` slots.  Every shard owns ``vnodes`` of them,
placed by a hash; a row starts at the slot its key hashes to and belongs to the
next virtual node clockwise.  A shard takes at most its capacity; rows beyond it
continue clockwise to the next virtual node whose shard has room.

Only per-slot counts reach the driver: at most ``2 ** ring_bits`` rows, however
large the table.  The walk around the ring turns them into rank intervals, which
go back as a broadcast table of at most ``2 ** ring_bits + n_shards * vnodes``
rows -- both bounds are parameters, not data.

Defined results: a null text has no bytes (size 1, CRC 0); a null doc_id is a key
like any other; repeated rows each take a slot of their own; an empty table gives
an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from topicloom.llm.common import land

N_SHARDS = 16
VNODES = 64
RING_BITS = 14

ALLOC = T.StructType(
    [
        T.StructField("ring_slot", T.IntegerType(), False),
        T.StructField("lo", T.LongType(), False),
        T.StructField("hi", T.LongType(), False),
        T.StructField("shard", T.IntegerType(), False),
        T.StructField("first_slot", T.LongType(), False),
    ]
)


def ring(n_shards: int, vnodes: int, ring_bits: int) -> list[tuple[int, int]]:
    """(ring slot, shard) of every virtual node, in ring order; a slot holds one
    node, the next free slot takes a node whose slot is taken."""
    size = 1 << ring_bits
    if n_shards * vnodes > size // 2:
        raise ValueError("the ring needs at least twice as many slots as virtual nodes")
    taken: dict[int, int] = {}
    for shard in range(n_shards):
        for replica in range(vnodes):
            at = int.from_bytes(hashlib.sha256(f"{shard}/{replica}".encode()).digest()[:8], "big") % size
            while at in taken:
                at = (at + 1) % size
            taken[at] = shard
    return sorted(taken.items())


def capacities(n_rows: int, n_shards: int, slack: float) -> list[int]:
    """Rows a shard may take.  No slack: floor or ceiling of the mean, in all exactly
    ``n_rows``, so every shard ends full and counts differ by one at most."""
    if slack > 0:
        return [-(-int(n_rows * (1 + slack) * 1_000_000) // (n_shards * 1_000_000)) + 1] * n_shards
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def allocate(counts: dict[int, int], nodes: list[tuple[int, int]], caps: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Walk the ring: (ring slot, lo, hi, shard, first slot in the shard), rows being
    ranked from 1 within their ring slot.

    First every shard keeps what hashes to it, up to its capacity; then what is
    left over continues clockwise.  So only rows beyond a capacity move."""
    used, out, left = [0] * len(caps), [], []
    slots = [at for at, _ in nodes]
    i = 0
    for at in sorted(counts):
        while i < len(slots) and slots[i] < at:
            i += 1
        node = i % len(nodes)
        shard = nodes[node][1]
        take = min(counts[at], caps[shard] - used[shard])
        if take:
            out.append((at, 1, take, shard, used[shard]))
            used[shard] += take
        if take < counts[at]:
            left.append((at, node, take, counts[at] - take))
    for at, node, done, rest in left:
        step = 0
        while rest:
            step += 1
            shard = nodes[(node + step) % len(nodes)][1]
            take = min(rest, caps[shard] - used[shard])
            if take:
                out.append((at, done + 1, done + take, shard, used[shard]))
                used[shard] += take
                done, rest = done + take, rest - take
            if step > len(nodes):
                raise AssertionError("capacities are smaller than the table")
    return out


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, vnodes: int = VNODES, ring_bits: int = RING_BITS, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs`` (doc_id, text).

    A row's place on the ring comes from its doc_id, size and CRC, so a doc_id
    shared by many different texts does not pile up in one slot.  Ranks in a slot
    follow (hash, doc_id, size, CRC): recomputing a lost partition gives the same
    ranks, up to rows that are equal in all of these."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("ring_hash", F.xxhash64("doc_id", "size", "text_crc32"))
    size = 1 << ring_bits
    rows = land(rows.withColumn("ring_slot", F.pmod(F.col("ring_hash"), F.lit(size)).cast("int")), "shard-rows")
    counts = {r["ring_slot"]: r["n"] for r in rows.groupBy("ring_slot").agg(F.count("*").alias("n")).collect()}
    nodes = ring(n_shards, vnodes, ring_bits)
    alloc = spark.createDataFrame(allocate(counts, nodes, capacities(sum(counts.values()), n_shards, slack), size), ALLOC)
    rank = F.row_number().over(Window.partitionBy("ring_slot").orderBy("ring_hash", "doc_id", "size", "text_crc32"))
    ranked = rows.withColumn("ring_rank", rank.cast("long"))
    placed = ranked.join(F.broadcast(alloc), "ring_slot").where("ring_rank between lo and hi")
    return placed.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("ring_rank") - F.col("lo")).alias("slot")
    )
