"""Operator 12: periodic runs of words, by tiles of each period octave.

A run is a longest stretch of words with smallest period q, ``max(24, 3 * q)`` words
long or more.  Octave P holds the periods P to 2P - 1; those from 1 to 7 are one
octave with P = 8.  A run of such a period repeats P words at a distance of q from the first
multiple of P in it; so the words from each multiple of P, a boundary, are compared
with those at all distances of the octave, by rolling hashes, and boundaries where
nothing repeats are passed over.

The others are exploded into tiles, up to eight neighbouring boundaries with P words
before and 4P behind, dealt out evenly and solved on their own: the Z-function from a
boundary tells for every period how far the repetition goes on, that of the reversed
words before it how far it goes back, both cut off at the tile.  Distances that are a
multiple of a smaller period are left out: such a stretch is a run of that period.
What is left are fragments (document, period, from, to).  They are shuffled by
document and period, and overlapping ones are stitched together; as the boundaries of
a run lie closer than the reach of a tile, its fragments always overlap.

Hashes only choose tiles; tiles compare numbers of distinct words.  No group is larger
than one document's boundaries.  Texts cross a shuffle only where a run may be.

Defined results: a null, empty or blank text has no words, no runs and the digests of
the empty string; rows equal in doc_id and text are rows of their own; ties between
the best runs go to the smallest start, then period; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.llm.common import land, texts

MIN_LENGTH = 24
MIN_COPIES = 3
#: Periods below it are one octave, boundaries at its multiples.
FIRST = 8
#: Boundaries of a tile.
SPAN = 8

_BASE = 0x9E3779B97F4A7C15
_SLICE = 8 << 20


class _Powers:
    """Powers of the hash base and of its inverse, as far as they were needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(4096, 1 << (n - 1).bit_length())
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(cls, name, np.multiply.accumulate(p))
        return cls.up[:n], cls.down[:n]


def octaves(n: int) -> list[int]:
    """The smallest period of each octave whose periods fit into n words."""
    out = [1] if n >= MIN_LENGTH else []
    low = FIRST
    while MIN_COPIES * low <= n:
        out.append(low)
        low *= 2
    return out


def bounds_of(octave: int) -> tuple[int, int]:
    """(distance of its boundaries, end of its periods)."""
    return (FIRST, FIRST) if octave < FIRST else (octave, 2 * octave)


def repeated_boundaries(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, boundaries whose P words come again at a distance of the octave)."""
    n = len(ids)
    if n < MIN_LENGTH:
        return
    up, down = _Powers.of(n + 1)
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(x * up[:n], out=sums[1:])
    for octave in octaves(n):
        p, end = bounds_of(octave)
        window = (sums[p:] - sums[:-p]) * down[: n - p + 1]
        at = window[::p]
        if octave < p:
            hit = np.zeros(len(at), bool)
            for q in range(octave, end):
                other = window[q::p]
                hit[: len(other)] |= other == at[: len(other)]
            found = np.flatnonzero(hit)
        else:  # the places P to 2P - 1 behind a boundary are those from the next boundary on
            later = window[p:]
            found = np.unique(np.flatnonzero(later == np.repeat(at, p)[: len(later)]) // p)
        if len(found):
            yield octave, found * p


def tiles(ids: np.ndarray) -> Iterator[tuple[int, int, list[int], np.ndarray]]:
    """(octave, place of its first word, boundaries in it, words) of each tile."""
    for octave, found in repeated_boundaries(ids):
        p, _ = bounds_of(octave)
        for part in np.split(found, np.flatnonzero(np.diff(found // p // SPAN)) + 1):
            lo = max(0, int(part[0]) - p)
            yield octave, lo, (part - lo).tolist(), ids[lo : int(part[-1]) + 4 * p]


def z_function(s: list[int], end: int) -> list[int]:
    """How long s[i:] agrees with s, for i below end."""
    n = len(s)
    z = [0] * max(end, 1)
    lo = hi = 0
    for i in range(1, end):
        k = 0
        if i < hi:
            k = z[i - lo]
            if k < hi - i:
                z[i] = k
                continue
            k = hi - i
        while i + k < n and s[i + k] == s[k]:
            k += 1
        z[i] = k
        if i + k > hi:
            lo, hi = i, i + k
    return z


def _primitive(z: list[int], q: int) -> bool:
    """The first q words are no repetition of a shorter word sequence."""
    r, rest = 2, q
    while r * r <= rest:
        if rest % r == 0:
            if z[q // r] >= q - q // r:
                return False
            while rest % r == 0:
                rest //= r
        r += 1
    return rest == 1 or z[q // rest] < q - q // rest


def solve(octave: int, boundaries: list[int], words: list[int]) -> list[tuple[int, int, int]]:
    """(period, from, to) of a tile: words from..to-1 come again a period later.

    Each stretch lies around a boundary; it is whole if it ends within 2P words behind
    the last and P before the first of its boundaries."""
    p, end = bounds_of(octave)
    found: dict[int, list[list[int]]] = {}
    for b in boundaries:
        ahead = words[b : b + 4 * p]
        last = min(2 * p, len(ahead))
        z = z_function(ahead, last)
        qs = [q for q in range(octave, min(end, last)) if z[q] >= p and _primitive(z, q)]
        if not qs:
            continue
        back = None
        for q in qs:
            to = b + min(z[q], 2 * p)
            held = found.setdefault(q, [])
            if held and held[-1][1] >= b:  # the boundary before reaches here
                held[-1][1] = max(held[-1][1], to)
                continue
            if back is None:
                before = words[max(0, b - p) : b][::-1]
                around = words[max(0, b - p) : b + 2 * p][::-1]
                back = z_function(before + [-1] + around, len(before) + 1 + len(around))
                start, ends = len(before) + 1, len(around) - len(before)
            held.append([b - (back[start + ends - q] if before else 0), to])
    return [(q, lo, hi) for q, held in found.items() for lo, hi in held]


def scan(docs: DataFrame) -> DataFrame:
    """A row a document (key, doc_id, n, plain, and body if tiles follow) and one a tile
    (key, octave, origin, bounds, words)."""
    schema = "key long, doc_id long, n long, plain string, body string, octave int, origin int, bounds binary, words binary"
    names = [x.split()[0] for x in schema.split(", ")]
    fields = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("plain", pa.string()), ("body", pa.string()), ("octave", pa.int32()), ("origin", pa.int32()), ("bounds", pa.binary()), ("words", pa.binary())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for key, doc_id, text in zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                split = text.encode("utf-8").split() if text else []
                number: dict[bytes, int] = {}
                ids = np.fromiter((number.setdefault(w, len(number)) for w in split), np.int32, len(split))
                body, any_tile = b" ".join(split), False
                for octave, lo, bounds, words in tiles(ids):
                    any_tile = True
                    rows.append((key, None, None, None, None, octave, lo, np.array(bounds, np.int32).tobytes(), words.tobytes()))
                    size += words.nbytes
                    if size >= _SLICE:
                        yield batch_of(rows)
                        rows, size = [], 0
                rows.append((key, doc_id, len(split), hashlib.sha256(body).hexdigest(), body.decode("utf-8") if any_tile else None, None, None, None, None))
                size += 200 + (len(body) if any_tile else 0)
                if size >= _SLICE:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long"), F.col("text"))
    return land(keyed.mapInArrow(step, schema).select(*names), "periods-scan")


def fragments(scanned: DataFrame) -> DataFrame:
    """(key, q, lo, hi): stretches whose words come again q later, tile by tile."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                found = solve(row["octave"], np.frombuffer(row["bounds"], np.int32).tolist(), np.frombuffer(row["words"], np.int32).tolist())
                out.extend((row["key"], q, lo + row["origin"], hi + row["origin"]) for q, lo, hi in found)
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(("key", "q", "lo", "hi"), cols)})

    tiles_of = scanned.where("octave is not null").select("key", "octave", "origin", "bounds", "words")
    dealt = tiles_of.repartition("key", "octave", "origin")
    return dealt.mapInArrow(step, "key long, q long, lo long, hi long")


def runs(scanned: DataFrame) -> DataFrame:
    """(key, start, length, period) of every run."""
    by = Window.partitionBy("key", "q").orderBy("lo", "hi")
    reach = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments(scanned).withColumn("new", F.when(F.col("lo") <= reach, 0).otherwise(1))
    islands = marked.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("key", "q", "island").agg(F.min("lo").alias("start"), (F.max("hi") - F.min("lo") + F.col("q")).alias("length"))
    return whole.where(F.col("length") >= F.greatest(F.lit(MIN_LENGTH), MIN_COPIES * F.col("q"))).select("key", "start", "length", F.col("q").alias("period"))


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run (start, length, period) holds after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def best(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    top = None
    for run in sorted(found, key=lambda r: (r[0], r[2])):
        if top is None or run[1] * top[2] > top[1] * run[2]:
            top = run
    return top


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256, collapsed) of every row; ``collapsed`` is the text without the
    repetitions where there are runs."""
    scanned = scan(docs)
    listed = runs(scanned).groupBy("key").agg(F.collect_list(F.struct("start", "length", "period")).alias("found"))
    held = scanned.where("octave is null").select("key", "doc_id", "plain", "body").join(listed.withColumnRenamed("key", "rk"), F.col("key") == F.col("rk"), "left")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed")
        for batch in batches:
            out = []
            for row in (r for i in range(0, batch.num_rows, 64) for r in batch.slice(i, 64).to_pylist()):
                found = sorted((r["start"], r["length"], r["period"]) for r in row["found"] or ())
                found.sort(key=lambda r: (r[0], r[2]))
                digest, text = row["plain"], None
                top = best(found) or (None, None, None)
                if found:
                    text = b" ".join(collapse(row["body"].encode("utf-8").split(b" "), found))
                    digest, text = hashlib.sha256(text).hexdigest(), text.decode("utf-8")
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                out.append((row["doc_id"], len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(), digest, text))
            types = [pa.int64()] * 6 + [pa.string()] * 3
            cols = list(zip(*out)) or [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=list(names))

    return held.select("doc_id", "plain", "body", "found").mapInArrow(
        step, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed string"
    )


def planted(text: Column, doc_id: Column) -> Column:
    """The text of the query: where crc32(decimal doc_id) is divisible by ten, words from
    the a-th on are the p words there over and over, by the numbers of the contract."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    copies = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), copies)), F.lit(1), n - a)
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)
