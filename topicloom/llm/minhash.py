"""Operator 13: near copies by b-bit MinHash.

A document's set holds its distinct shingles of three words; two documents link when
100 * intersection >= 85 * union.  Equal sets are one class first (128-bit keys).

1. Signatures.  160 minima of a class's set under as many hash functions.  Five at a
   time are hashed into the 32 keys of its bands; of each, the two low bits are packed
   into five longs.  A linked pair shares no band with probability below
   (1 - 0.85 ** 5) ** 32, some 7e-9.
2. Candidates are classes that share a band.  Their similarity is estimated from the
   number of equal 2-bit values, a quarter of which agree by chance: a bit count of
   two packed signatures.  Pairs below ``MIN_EQUAL`` go; a linked pair falls below
   it with probability under 1e-9 (the binomial tail at 0.85).
3. Confirmation compares full sets.  First, in ``HUB_ROUNDS`` rounds, every class is
   compared with one hub of its buckets, that with the best estimate, and links make
   components.  Buckets that still hold classes of two components are joined to blocks.
   In a block, every class outside the largest component is compared with all the
   others: by bit counts, then by full sets, inside tasks.  No pair is listed; a task
   holds two chunks of sets at most.

Pairs with a hub are confirmed hub by hub: a hub's set is held while its partners' sets
stream past, hubs with many partners are split over tasks.  Buckets are aggregated
before the shuffle and joins on them can be split as their other side has a row a
bucket.  The work in a block grows with the product of its classes and of those that no
hub has linked to the largest component.

Defined results: a null, empty or blank text has an empty set, links with nothing and
is its own component; texts of one or two words have one shingle, the whole; rows with
equal doc_id are rows of their own; a null doc_id stays null, so do its component_id and
kept; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import components, land, texts

WORDS = 3
PERCENT = 85
HASHES, ROWS = 160, 5
BANDS = HASHES // ROWS
BITS = 2
HUB_ROUNDS = 2
#: Shingles that stream past one copy of a hub, about; shingles of a chunk of a block.
PART_SHINGLES = 2_000_000
CHUNK_SHINGLES = 1_000_000
#: Links that a task joins before the steps over the cluster.
CONTRACT_LINKS = 200_000
#: Rows of (doc_id, hash) that may be sent to all executors: 32 MB at most.
MAX_SMALL = 500_000


def min_equal(miss: float = 1e-9) -> int:
    """Most equal values that a linked pair still reaches with probability 1 - miss."""
    p = PERCENT / 100 + (1 - PERCENT / 100) / 2**BITS
    tail, m = 0.0, 0
    while True:
        tail += math.comb(HASHES, m) * p**m * (1 - p) ** (HASHES - m)
        if tail > miss:
            return m
        m += 1


MIN_EQUAL = min_equal()

#: Packed signatures: longs, and their columns.
LONGS = HASHES * BITS // 64
SIG = [f"s{i}" for i in range(LONGS)]

_FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_RNG = np.random.default_rng(13)
_ODD = (_RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_SEEDS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


class _Words(dict):
    """Word hashes of a worker; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles."""
    split = text.encode("utf-8").translate(_FOLD).split() if text else []
    n = len(split)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, split), np.uint64, n)
    k = min(n, words)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):  # the order of the words counts
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : n - k + 1 + i])
    return np.unique(out)


def class_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def minima(s: np.ndarray) -> np.ndarray:
    """The least value of a set under each hash function."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = (_ODD * x[:4096]).min(axis=1)
    for i in range(4096, len(x), 4096):
        np.minimum(out, (_ODD * x[i : i + 4096]).min(axis=1), out=out)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key a band; bands differ in their seed."""
    rows = least.astype(np.uint64).reshape(BANDS, ROWS)
    out = _SEEDS[:BANDS].copy()
    for i in range(ROWS):
        out = _mixed(out ^ rows[:, i])
    return out


def packed(least: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, hashed once more, in longs."""
    bits = (_mixed(least.astype(np.uint64) ^ _SEEDS) & np.uint64(3)).reshape(-1, 32)
    return np.bitwise_or.reduce(bits << (np.uint64(2) * np.arange(32, dtype=np.uint64)), axis=1)


def signed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n, key, bands, s0, s1, ...) of every row; nothing but n = 0 without shingles."""
    schema = "doc_id long, th long, n long, key binary, bands array<long>" + "".join(f", {c} long" for c in SIG)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, bands, sig = [], [], [], []
            for text in texts(batch.column("text")):
                s = shingle_set(text)
                n.append(len(s))
                least = minima(s) if len(s) else None
                key.append(class_key(s) if len(s) else None)
                bands.append(band_keys(least).view(np.int64) if len(s) else None)
                sig.append(packed(least).view(np.int64).tolist() if len(s) else [None] * LONGS)
            cols = {"doc_id": batch.column("doc_id"), "th": batch.column("th"), "n": pa.array(n, pa.int64()), "key": pa.array(key, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64()))}
            cols |= {c: pa.array([x[i] for x in sig], pa.int64()) for i, c in enumerate(SIG)}
            yield pa.RecordBatch.from_pydict(cols)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text").mapInArrow(step, schema)


def equal_values(a: str, b: str) -> Column:
    """How many of the 2-bit values of the signatures a0, a1, ... and b0, b1, ... agree."""
    out = F.lit(HASHES)
    for i in range(LONGS):
        x = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        out = out - F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(0x5555555555555555))
    return out


def estimate(equal: Column) -> Column:
    """Similarity from the share of equal values, less those that agree by chance."""
    chance = 1 / 2**BITS
    return (equal / HASHES - chance) / (1 - chance)


def _signature(classes: DataFrame, key: str, name: str) -> DataFrame:
    return classes.select(F.col("key").alias(key), *[F.col(c).alias(f"{name}{i}") for i, c in enumerate(SIG)])


def confirm(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link, by their full sets; b is the hub."""
    sized = pairs.join(classes.select(F.col("key").alias("a"), "n"), "a")
    load = sized.groupBy("b").agg(F.ceil(F.sum("n") / PART_SHINGLES).cast("int").alias("parts"))
    spread = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    partners = pairs.join(load, "b").select(F.col("a").alias("key"), F.col("b").alias("hub"), spread.alias("part"), F.lit(1).alias("turn"))
    hubs = load.select(F.col("b").alias("key"), F.col("b").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("turn"))
    held = sets.join(_small(partners.unionByName(hubs)), "key")
    dealt = held.repartition("hub", "part").sortWithinPartitions("hub", "part", "turn")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                s = np.frombuffer(batch.column("hashes")[i].as_py(), np.uint64)
                if batch.column("turn")[i].as_py() == 0:
                    hub, hub_set = batch.column("hub")[i].as_py(), s
                    continue
                if hub != batch.column("hub")[i].as_py() or min(len(s), len(hub_set)) * 100 < PERCENT * max(len(s), len(hub_set)):
                    continue
                at = np.minimum(np.searchsorted(hub_set, s), len(hub_set) - 1)
                both = int((hub_set[at] == s).sum())
                if 100 * both >= PERCENT * (len(s) + len(hub_set) - both):
                    a.append(batch.column("key")[i].as_py())
                    b.append(hub)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return dealt.select("hub", "turn", "key", "hashes").mapInArrow(step, "a binary, b binary")


def linked_components(links: DataFrame, name: str) -> DataFrame:
    """(v, comp) of the landed links (a, b).  Tasks first join what ``CONTRACT_LINKS`` links tell
    and pass on a star for each; the steps over the cluster start from there."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(x), find(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
        star = [(x, find(x)) for x in list(up) if find(x) != x]
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in star], pa.binary()), "b": pa.array([y for _, y in star], pa.binary())})

    parts = max(1, -(-links.count() // CONTRACT_LINKS))
    return components(links.select("a", "b").coalesce(parts).mapInArrow(contract, "a binary, b binary"), name)


def _small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has ``MAX_SMALL`` rows at most."""
    few = df.limit(MAX_SMALL + 1).count() <= MAX_SMALL
    return F.broadcast(df) if few else df


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, hashes) of the wanted classes (key, doc_id, th), from the texts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                made = [shingle_set(t) for t in part.column("text").to_pylist()]
                same = [class_key(s) == k for s, k in zip(made, part.column("key").to_pylist())]
                out = pa.RecordBatch.from_pydict({"key": part.column("key"), "hashes": pa.array([s.tobytes() for s in made], pa.binary())})
                yield out.filter(pa.array(same, pa.bool_()))

    w = _small(wanted.select("key", F.col("doc_id").alias("_wd"), F.col("th").alias("_wt")))
    rows = docs.select(F.col("doc_id").cast("long").alias("_rd"), F.xxhash64("text").alias("_rt"), "text")
    return rows.join(w, (F.col("_rt") == F.col("_wt")) & F.col("_rd").eqNullSafe(F.col("_wd"))).select("key", "text").mapInArrow(step, "key binary, hashes binary")


def _open_buckets(shared: DataFrame, links: DataFrame | None, name: str) -> DataFrame:
    """Rows (bucket, key, comp) of the buckets that hold classes of two components."""
    if links is None:
        return shared.withColumn("comp", F.col("key"))
    comps = linked_components(links, f"{name}-comps")
    with_comp = shared.join(comps.select(F.col("v").alias("key"), "comp"), "key", "left").select("bucket", "key", F.coalesce("comp", "key").alias("comp"))
    mixed = with_comp.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
    return land(with_comp.join(mixed, "bucket"), f"{name}-open")


def near_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): confirmed links that join all classes of a component."""
    lists = classes.select("key", F.explode("bands").alias("bucket"))
    common = lists.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    shared = land(lists.join(common, "bucket"), "minhash-shared")
    wanted = classes.join(shared.select("key").distinct(), "key", "left_semi")
    sets = land(class_sets(docs, wanted), "minhash-sets")
    links = None
    for turn in range(HUB_ROUNDS):
        rows = _open_buckets(shared, links, f"minhash-{turn}")
        hub = F.min(F.struct(F.xxhash64("key", F.lit(turn)), "key", "comp"))
        hubs = rows.groupBy("bucket").agg(hub.alias("h")).select("bucket", F.col("h.key").alias("b"), F.col("h.comp").alias("hub_comp"))
        pairs = rows.join(hubs, "bucket").where("comp <> hub_comp").select(F.col("key").alias("a"), "b").distinct()
        rated = pairs.join(_signature(classes, "a", "p"), "a").join(_signature(classes, "b", "q"), "b").withColumn("equal", equal_values("p", "q"))
        best = rated.where(F.col("equal") >= MIN_EQUAL).groupBy("a").agg(F.max(F.struct("equal", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        found = land(confirm(land(best, f"minhash-pairs-{turn}"), classes, sets), f"minhash-links-{turn}")
        links = found if links is None else links.unionByName(found)
    rows = _open_buckets(shared, links, "minhash-rest")
    return links.unionByName(land(block_links(rows, classes, sets), "minhash-links-rest"))


def block_links(rows: DataFrame, classes: DataFrame, sets: DataFrame, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """(a, b): links between different components of the open buckets (bucket, key, comp)."""
    low = rows.groupBy("bucket").agg(F.min("comp").alias("b"))
    edges = land(rows.join(low, "bucket").where("comp <> b").select(F.col("comp").alias("a"), "b").distinct(), "minhash-edges")
    blocks = linked_components(edges, "minhash-blocks").select(F.col("comp").alias("block"), F.col("v").alias("comp"))
    members = rows.select("key", "comp").distinct().join(blocks, "comp").join(classes.select("key", "n", *SIG), "key")
    members = land(members, "minhash-members")
    by_comp = members.groupBy("block", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"))
    top = by_comp.groupBy("block").agg(F.max(F.struct("m", "comp", "shingles")).alias("top"), F.sum("shingles").alias("total"))
    chunks = lambda x: F.greatest(F.ceil(x / chunk_shingles), F.lit(1)).cast("int")
    top = top.select("block", F.col("top.comp").alias("main"), chunks(F.col("top.shingles")).alias("mains"), chunks(F.col("total") - F.col("top.shingles")).alias("rests"))
    rest = F.col("comp") != F.col("main")
    own = F.pmod(F.xxhash64("key"), F.when(rest, F.col("rests")).otherwise(F.col("mains"))).cast("int")
    task = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    among = F.transform(F.sequence(F.lit(0), F.col("rests") - 1), lambda t: task(0, F.least(t, "own"), F.greatest(t, "own")))
    to_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda t: task(1, F.col("own"), t))
    from_main = F.transform(F.sequence(F.lit(0), F.col("rests") - 1), lambda t: task(1, t, F.col("own")))
    placed = members.join(top, "block").withColumn("rest", rest).withColumn("own", own)
    placed = placed.withColumn("t", F.explode(F.when(F.col("rest"), F.concat(among, to_main)).otherwise(from_main)))
    placed = placed.select("key", "comp", "rest", "own", "block", "t.kind", "t.i", "t.j", *SIG)
    place = ["block", "kind", "i", "j"]
    dealt = sets.join(_small(placed), "key").repartition(*place).sortWithinPartitions(*place)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            part = list(zip(*(batch.column(c).to_pylist() for c in place)))
            cuts = [0, *(n for n in range(1, len(part)) if part[n] != part[n - 1]), len(part)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b and part[a] != now:
                    yield _linked(now, held)
                    now, held = part[a], []
                if a < b:
                    held.append(batch.slice(a, b - a))
        yield _linked(now, held)

    return dealt.select(*place, "key", "comp", "rest", "own", "hashes", *SIG).mapInArrow(step, "a binary, b binary")


def _linked(place: tuple | None, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Links of a task's sets that join different components; a star for each."""
    empty = pa.RecordBatch.from_pydict({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
    if not held:
        return empty
    table = pa.Table.from_batches(held)
    keys, comps = table.column("key").to_pylist(), table.column("comp").to_pylist()
    once = list({k: n for n, k in enumerate(keys)}.values())  # a class may come with several equal texts
    table, keys, comps = table.take(once), [keys[n] for n in once], [comps[n] for n in once]
    sets = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
    sig = np.column_stack([table.column(c).to_numpy() for c in SIG]).view(np.uint64)
    own, rest = table.column("own").to_numpy(), np.array(table.column("rest").to_pylist(), bool)
    _, kind, i, j = place
    number: dict = {}
    label = np.array([number.setdefault(c, len(number)) for c in comps])
    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    member = np.zeros(int(flat.max()) + 1, bool)
    order = np.arange(len(sets))
    out: list[tuple] = []
    for q in np.flatnonzero(rest & (own == i)).tolist():
        if kind == 1:
            others = ~rest
        else:
            others = rest & (own == j) & ((order > q) | (i != j))
        near = np.flatnonzero(others & (label != label[q]) & (100 * np.minimum(sizes, sizes[q]) >= PERCENT * np.maximum(sizes, sizes[q])))
        x = sig[near] ^ sig[q]
        equal = HASHES - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1, dtype=np.int64)
        near = near[equal >= MIN_EQUAL]
        if not len(near):
            continue
        mine = flat[ends[q] - sizes[q] : ends[q]]
        member[mine] = True
        starts = ends[near] - sizes[near]
        at = np.concatenate([flat[a:b] for a, b in zip(starts.tolist(), ends[near].tolist())])
        both = np.add.reduceat(member[at], np.cumsum(sizes[near]) - sizes[near], dtype=np.int64)
        member[mine] = False
        for n in near[100 * both >= PERCENT * (sizes[near] + sizes[q] - both)].tolist():
            if label[n] != label[q]:
                out.append((keys[q], keys[n]))
                label[label == label[n]] = label[q]
    return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())}) if out else empty


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    rows = land(signed_rows(docs), "minhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th"))
    same = [F.first(c).alias(c) for c in ("n", "bands", *SIG)]
    classes = rows.where("n > 0").groupBy("key").agg(first.alias("f"), *same)
    classes = land(classes.select("key", F.col("f.doc_id").alias("doc_id"), F.col("f.th").alias("th"), "n", "bands", *SIG), "minhash-classes")
    comps = linked_components(near_links(docs, classes), "minhash-components")
    rows = rows.select("doc_id", "n", "key").join(comps.select(F.col("v").alias("key"), "comp"), "key", "left")
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "key").alias("comp"))
    least = rows.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "comp", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
