"""Operator 8: n-gram Jaccard join with a prefix tree.

A document's set holds its distinct shingles of five words.  Two documents link at
100 * intersection >= 75 * union.  Equal sets are one class first, so copies are never
compared.  Then:

1. Candidates.  Of a set of n shingles, in hash order, the first m + l are taken,
   m = n // 4 being the most that a linked partner can lack and l = n // 8 + 1; two
   linked sets share at least l(ceil(3n/4)) of these.  Reducers by hash range find the
   taken shingles that two classes or more have, and how many.  A class keeps the
   rarest of them, less those it can spare and still meet every partner; classes
   that keep a common shingle fall into one block (connected components).
2. Join.  A block's sets go into a prefix tree, ordered by frequency, and each set
   walks the tree: overlaps on a shared path are counted once for all sets below it,
   and a subtree goes when the lengths left can no longer reach the threshold, or
   when all of it is linked to the set already.  Blocks beyond ``chunk_shingles`` are
   split by hash into chunks, and each pair of chunks is one task: memory stays
   bounded, no pair is lost, no pair is listed.
3. Components of the links give every document its class.

Shingles are 64-bit hashes; sets are compared by these, so a wrong decision needs a
collision between two documents' few thousand shingles (below 1e-12 for a pair).

Defined results: a null, empty or blank text has an empty set, links with nothing and
is its own component; texts of one to four words have one shingle, the whole; rows
with equal doc_id are one vertex with the union of their links, each row keeping its
own n_shingles; a null doc_id stays null, its component_id is null; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.llm.common import components, land, texts

WORDS = 5
CHUNK_SHINGLES = 1_000_000
#: Taken shingles a reducer holds at a time, about; a slice of rows a mapper packs.
RANGE_SHINGLES = 500_000
SLICE_BYTES = 4 << 20

_FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    """Word hashes of a worker; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = text.encode("utf-8").translate(_FOLD).split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    k = min(n, WORDS)
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total += _mix(h[i : n - k + 1 + i]) * _FACTORS[i]
    return np.unique(_mix(total))


def set_key(s: np.ndarray) -> int:
    """64 bits of the whole set, as a signed long."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))


def taken(n: int) -> int:
    return min(n, n // 4 + spare(n))


def spare(n: int) -> int:
    return n // 8 + 1


def needed(n: int) -> int:
    """Shared taken shingles that any linked partner guarantees."""
    return spare(-(-3 * n // 4))


def set_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key): every row's set size and class."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key = [], []
            for text in texts(batch.column("text")):
                s = shingles(text)
                n.append(len(s))
                key.append(set_key(s))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_shingles": pa.array(n, pa.int64()), "key": pa.array(key, pa.int64())})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(step, "doc_id long, n_shingles long, key long")


def _by_range(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int32)


def _packed(docs: DataFrame, ranges: int) -> DataFrame:
    """Taken shingles by hash range: one row holds those of a slice of documents.

    ``keys`` are the slice's classes and sizes, ``owner`` says whose a hash is."""
    schema = "part int, hashes binary, owner binary, keys binary"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = {}, 0
            for text in texts(batch.column("text")):
                s = shingles(text)
                if len(s):
                    held.setdefault(set_key(s), (len(s), s[: taken(len(s))]))
                size += len(s) * 8
                if size >= SLICE_BYTES or len(held) >= 60_000:
                    yield pack(held)
                    held, size = {}, 0
            if held:
                yield pack(held)

    def pack(held: dict) -> pa.RecordBatch:
        hashes = np.concatenate([s for _, s in held.values()])
        owner = np.repeat(np.arange(len(held), dtype=np.uint16), [len(s) for _, s in held.values()])
        keys = np.array([[k, n] for k, (n, _) in held.items()], np.int64)
        order = np.argsort(hashes)
        hashes, owner = hashes[order], owner[order]
        part = _by_range(hashes, ranges)
        cuts = np.flatnonzero(np.diff(part)) + 1
        lo, hi = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(part)]])
        out = {"part": [], "hashes": [], "owner": [], "keys": []}
        for a, b in zip(lo, hi):
            used, local = np.unique(owner[a:b], return_inverse=True)
            out["part"].append(int(part[a]))
            out["hashes"].append(hashes[a:b].tobytes())
            out["owner"].append(local.astype(np.uint16).tobytes())
            out["keys"].append(keys[used].tobytes())
        return pa.RecordBatch.from_pydict({"part": pa.array(out["part"], pa.int32()), **{k: pa.array(out[k], pa.binary()) for k in ("hashes", "owner", "keys")}})

    return docs.select("text").mapInArrow(step, schema)


def _shared(packed: DataFrame) -> DataFrame:
    """The taken shingles that two classes or more have: (key, n, hash, df), once a class."""

    def one(table: pa.Table) -> pa.Table:
        hashes, keys, sizes = [], [], []
        for row in (x for i in range(table.num_rows) for x in table.slice(i, 1).to_pylist()):
            h = np.frombuffer(row["hashes"], np.uint64)
            k = np.frombuffer(row["keys"], np.int64).reshape(-1, 2)[np.frombuffer(row["owner"], np.uint16)]
            hashes.append(h)
            keys.append(k[:, 0])
            sizes.append(k[:, 1])
        h, k, n = (np.concatenate(x) for x in (hashes, keys, sizes))
        order = np.lexsort((k, h))
        h, k, n = h[order], k[order], n[order]
        new_hash = np.concatenate([[True], h[1:] != h[:-1]])
        new_key = new_hash | np.concatenate([[True], k[1:] != k[:-1]])
        group = np.cumsum(new_hash) - 1
        count = np.bincount(group, new_key).astype(np.int64)[group]
        keep = new_key & (count > 1)  # one row a class: copies in other slices say nothing new
        h, k, n, c = h[keep], k[keep], n[keep], count[keep]
        return pa.table({"key": k, "n": n, "hash": h.view(np.int64), "df": c})

    return packed.groupBy("part").applyInArrow(one, "key long, n long, hash long, df long")


def candidates(docs: DataFrame, n_shingles: int) -> DataFrame:
    """(a, b): edges between classes that keep a common shingle, as a star for each shingle."""
    ranges = max(12, -(-(n_shingles * 3 // 8) // RANGE_SHINGLES))
    shared = land(_shared(_packed(docs, ranges)), "jac-shared")

    # Rarest first; what a class can spare is its most frequent.
    spared = F.floor(F.ceil(F.col("n") * 3 / 4) / 8).cast("int")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("df", "hash"))
    held = F.count("*").over(Window.partitionBy("key"))
    lists = land(shared.withColumn("r", rank).withColumn("held", held).where(F.col("r") <= F.col("held") - spared).select("key", "hash"), "jac-lists")
    hub = lists.groupBy("hash").agg(F.min("key").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition's edges as stars: groups that share many shingles come out as one.
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(x), find(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
        star = [(x, find(x)) for x in list(up) if find(x) != x]
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in star], pa.int64()), "b": pa.array([y for _, y in star], pa.int64())})

    edges = lists.join(hub, "hash").where("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b"))
    return edges.mapInArrow(contract, "a long, b long")


class PrefixTree:
    """A path-compressed tree of distinct ordered sets, as arrays over its nodes.

    ``flat[seg[v] : seg[v] + size[v]]`` are a node's own elements, ``row[v]`` the set that
    ends at it or -1, ``least`` and ``most`` the sizes of the sets at it and below."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        segments, self.parent, self.depth, self.row = [np.empty(0, np.int64)], [-1], [0], [-1]
        self.segments = segments
        path, before = [0], np.empty(0, np.int64)
        for i in self.order:
            s = sets[i]
            m = min(len(s), len(before))
            diff = np.flatnonzero(s[:m] != before[:m])
            common = int(diff[0]) if len(diff) else m
            last = 0
            while self.depth[path[-1]] > common:
                last = path.pop()
            if self.depth[path[-1]] < common:  # the node popped last is cut in two
                own = common - self.depth[path[-1]]
                path.append(self._add(path[-1], segments[last][:own]))
                segments[last] = segments[last][own:]
                self.parent[last] = path[-1]
            if len(s) > common:
                path.append(self._add(path[-1], s[common:]))
            self.row[path[-1]] = i
            before = s
        n = len(segments)
        self.size = np.array([len(x) for x in segments])
        self.seg = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.flat = np.concatenate(segments)
        self.last = np.array([x[-1] if len(x) else -1 for x in segments])
        self.parent, self.depth, self.row = (np.array(x) for x in (self.parent, self.depth, self.row))
        del self.segments
        by = np.argsort(self.parent, kind="stable")[1:]
        self.kid = by
        self.kids = np.searchsorted(self.parent[by], np.arange(n + 1))
        self.least, self.most = np.where(self.row >= 0, self.depth, 1 << 60), np.where(self.row >= 0, self.depth, 0)
        for v in np.argsort(-self.depth, kind="stable").tolist()[:-1]:
            up = self.parent[v]
            self.least[up] = min(self.least[up], self.least[v])
            self.most[up] = max(self.most[up], self.most[v])

    def _add(self, parent: int, segment: np.ndarray) -> int:
        self.segments.append(segment)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + len(segment))
        self.row.append(-1)
        return len(self.depth) - 1

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of ``nodes``, and for each the position of its parent there."""
        count = self.kids[nodes + 1] - self.kids[nodes]
        up = np.repeat(np.arange(len(nodes)), count)
        return self.kid[_ranges(self.kids[nodes], count)], up

    def partners(self, s: np.ndarray, member: np.ndarray, marked: np.ndarray) -> np.ndarray:
        """Rows of the sets at marked nodes that link with ``s``, whose elements are set in
        ``member``.  One level at a time; what a path has in common is counted once."""
        n, found = len(s), []
        nodes, up = self.below(np.array([0]))
        overlap = np.zeros(1, np.int64)
        while len(nodes):
            go = marked[nodes]
            nodes, overlap = nodes[go], overlap[up[go]]
            if not len(nodes):
                break
            size = self.size[nodes]
            hits = member[self.flat[_ranges(self.seg[nodes], size)]]
            overlap = overlap + np.add.reduceat(hits, np.cumsum(size) - size, dtype=np.int64)
            left = n - np.searchsorted(s, self.last[nodes], "right")
            d = self.depth[nodes]
            # 7 * intersection >= 3 * (both sizes), with the best that may still come.
            go = (4 * self.most[nodes] >= 3 * n + 7 * (d - overlap)) & (7 * (overlap + left) >= 3 * (n + self.least[nodes]))
            nodes, overlap, d = nodes[go], overlap[go], d[go]
            row = self.row[nodes]
            found.append(row[(row >= 0) & (7 * overlap >= 3 * (n + d))])
            nodes, up = self.below(nodes)
        return np.concatenate(found) if found else np.empty(0, np.int64)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for count[0] numbers, then the same from start[1], ..."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def link_sets(sets: list[np.ndarray]) -> np.ndarray:
    """For each of the sets (sorted uint64 arrays, no two alike) the position that labels
    its component under all links among them.

    A set's partners share at least spare(smaller size) taken shingles with it; those
    sets are counted over posting lists, then checked in one walk of the tree, along
    the paths that lead to them.  What is linked to the set already is left out."""
    n = len(sets)
    label = np.arange(n)
    if n < 2:
        return label
    sizes = np.array([len(s) for s in sets])
    values, inverse, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -df))] = np.arange(len(values))
    ids = np.split(inverse, np.cumsum(sizes)[:-1])
    ordered = [np.sort(rank[x]) for x in ids]
    tree = PrefixTree(ordered)
    spares = sizes // 8 + 1
    heads = [x[: taken(len(x))] for x in ids]
    owner = np.repeat(np.arange(n), [len(x) for x in heads])
    element = np.concatenate(heads)
    by = np.argsort(element, kind="stable")
    posts, element = owner[by], element[by]
    start = np.searchsorted(element, np.arange(len(values) + 1))
    live = np.diff(start) > 1
    full = np.flatnonzero(live)
    kept_posts = posts[np.repeat(live, np.diff(start))]
    at_full = np.concatenate([[0], np.cumsum(np.diff(start)[full])])[:-1].astype(np.int64)
    where = np.zeros(n, np.int64)
    ends = np.flatnonzero(tree.row >= 0)
    where[tree.row[ends]] = ends
    member = np.zeros(len(values), bool)
    marked = np.zeros(len(tree.row), bool)
    turn = np.empty(n, np.int64)
    turn[tree.order] = np.arange(n)
    stale, due = False, 1
    for done, q in enumerate(tree.order):
        if stale and done >= due:  # lists of one component have nothing to tell
            now = label[kept_posts]
            live[full] = np.minimum.reduceat(now, at_full) != np.maximum.reduceat(now, at_full)
            stale, due = False, done + min(64, done)
        lists = heads[q][live[heads[q]]]
        if not len(lists):
            continue
        count = np.bincount(posts[_ranges(start[lists], start[lists + 1] - start[lists])], minlength=n)
        nq = int(sizes[q])
        fits = (turn > done) & (count >= np.minimum(spares, spares[q])) & (label != label[q]) & (4 * sizes >= 3 * nq) & (4 * nq >= 3 * sizes)
        rows = np.flatnonzero(fits)
        if not len(rows):
            continue
        touched, up = [], where[rows]
        while len(up):
            up = np.unique(up[~marked[up]])
            marked[up] = True
            touched.append(up)
            up = tree.parent[up]
            up = up[up > 0]
        member[ordered[q]] = True
        for i in tree.partners(ordered[q], member, marked).tolist():
            lo, hi = sorted((int(label[i]), int(label[q])))
            if fits[i] and lo != hi:
                label[label == hi] = lo
                stale = True
        member[ordered[q]] = False
        marked[np.concatenate(touched)] = False
    return label


def links(docs: DataFrame, rows: DataFrame, blocks: DataFrame, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """(a, b): a star for every set of linked classes of a task, from the blocks (key, block)."""
    chosen = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n")).join(blocks, "key")
    size = chosen.groupBy("block").agg(F.sum("n").alias("shingles"))
    chosen = land(chosen.join(size.withColumn("chunks", F.ceil(F.col("shingles") / chunk_shingles).cast("int")), "block").drop("shingles"), "jac-chosen")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingles(t) for t in texts(batch.column("text"))]
            same = [set_key(s) == k for s, k in zip(made, batch.column("key").to_pylist())]
            out = pa.RecordBatch.from_pydict({"key": batch.column("key"), "block": batch.column("block"), "chunks": batch.column("chunks"), "hashes": pa.array([s.tobytes() for s in made], pa.binary())})
            yield out.filter(pa.array(same, pa.bool_()))

    members = docs.select(F.col("doc_id").cast("long"), "text").join(chosen.drop("n").hint("merge"), "doc_id").select("key", "block", "chunks", "text")
    sets = land(members.mapInArrow(pack, "key long, block long, chunks int, hashes binary"), "jac-sets")
    own = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    sets = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    sets = sets.select("key", "hashes", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def one(table: pa.Table) -> pa.Table:
        unique = dict(zip(table.column("key").to_pylist(), table.column("hashes").to_pylist()))
        keys = list(unique)
        label = link_sets([np.frombuffer(unique[k], np.uint64) for k in keys]).tolist()
        root: dict[int, int] = {}
        for k, x in zip(keys, label):
            root[x] = min(k, root.get(x, k))
        star = [(k, root[x]) for k, x in zip(keys, label) if k != root[x]]
        return pa.table({"a": pa.array([a for a, _ in star], pa.int64()), "b": pa.array([b for _, b in star], pa.int64())})

    return sets.groupBy("block", "i", "j").applyInArrow(one, "a long, b long")


def jaccard_components(docs: DataFrame, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = land(set_rows(docs), "jac-rows")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    blocks = components(candidates(docs, total), "jac-blocks").select(F.col("v").alias("key"), F.col("comp").alias("block"))
    found = land(links(docs, rows, blocks, chunk_shingles), "jac-links")
    classes = components(found, "jac-classes").select(F.col("v").alias("key"), "comp")
    rows = rows.join(classes, "key", "left").withColumn("class", F.coalesce("comp", "key"))
    rows = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("class")).alias("class"))
    firsts = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"))
    return rows.join(firsts, "class", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest doc_id (of
    rows with that doc_id, all).  Rows with null doc_id stay."""
    found = land(jaccard_components(docs), "jac-found")
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias("__jac_keep")).distinct()
    return docs.join(keep, docs["doc_id"] == F.col("__jac_keep"), "left").where(F.col("__jac_keep").isNotNull() | docs["doc_id"].isNull()).select(*docs.columns)
