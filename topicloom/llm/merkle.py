"""Operator 11: a Merkle manifest of a table in van Emde Boas layout.

Every row is a leaf; the leaves of a group (a language), in id order, make a tree of
arity 8, and the groups' roots, in group order, make one more.  A tree is cut into
aligned blocks of ``HEIGHT`` levels.  A block's digests are one binary value in van
Emde Boas order: the levels are split at half height, the upper part first, then the
lower parts one after another, each laid out the same way.  ``address`` computes the
place of a node from its depth and number; construction and the retrieval of a
leaf's siblings both use it, and no pointers are stored.  The roots of the blocks are
the leaves of the next tier's blocks, until a group has one node left.

Ranks come from one range partitioning by (group, id), written before it is counted,
and from counts by partition; rows that tie are dealt by their place in the input, so
neither a hot group nor copies fill one partition.  A block is one row of at most 512
leaves.  From the top down each block is given the siblings between its root and the
table's; a leaf's proof is its siblings in the block, followed by those.

Defined results: rows ascend by group (null first, UTF-8 bytewise), id (null first)
and leaf digest; rows equal in all of these are leaves of their own with the same
digests.  A field counts by its value alone, so empty and null differ.  No rows give no
tree.  A row whose presented text is null presents null.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.llm.common import land

ARITY = 8
BITS = 3
#: Levels of hashing in a block: 8 ** HEIGHT leaves at most.
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "array<struct<pos:int,siblings:binary>>"


def tree_size(levels: int) -> int:
    """Nodes of a full tree with so many levels of nodes."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, number: np.ndarray | int):
    """Place of node ``number`` at ``depth`` (root: 0) in a full tree in van Emde Boas order."""
    if levels == 1:
        return number * 0
    top = levels // 2
    if depth < top:
        return address(top, depth, number)
    below = levels - top
    tree = number >> BITS * (depth - top)
    inner = number - (tree << BITS * (depth - top))
    return tree_size(top) + tree * tree_size(below) + address(below, depth - top, inner)


@lru_cache(maxsize=64)
def _places(height: int, level: int) -> list[int]:
    """Byte offsets of the nodes of a level (leaves: 0) of a block of this height."""
    return (32 * address(height + 1, height - level, np.arange(ARITY ** (height - level)))).tolist()


def height_of(nodes: int) -> int:
    """Levels of hashing that a block has in a tree over so many nodes."""
    h = 0
    while h < HEIGHT and ARITY**h < nodes:
        h += 1
    return h


def hash_hex(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode("ascii")).hexdigest()


class Block:
    """An aligned subtree: ``count`` leaves, its digests in van Emde Boas order."""

    def __init__(self, height: int, count: int, data: bytes | bytearray | None = None):
        self.height, self.count = height, count
        self.data = bytearray(32 * tree_size(height + 1)) if data is None else data

    @classmethod
    def of(cls, leaves: list[bytes], tree_nodes: int) -> Block:
        block = cls(height_of(tree_nodes), len(leaves))
        for at, digest in zip(_places(block.height, 0), leaves):
            block.data[at : at + 32] = digest
        for level in range(1, block.height + 1):
            up = _places(block.height, level)
            for i in range(block.width(level)):
                block.data[up[i] : up[i] + 32] = bytes.fromhex(hash_hex(*block.run(level - 1, i)))
        return block

    def width(self, level: int) -> int:
        return -(-self.count // ARITY**level)

    def node(self, level: int, i: int) -> str:
        at = _places(self.height, level)[i]
        return self.data[at : at + 32].hex()

    def run(self, level: int, parent: int) -> list[str]:
        """Digests of the consecutive nodes below one node."""
        first = parent * ARITY
        return [self.node(level, i) for i in range(first, min(first + ARITY, self.width(level)))]

    @property
    def root(self) -> bytes:
        return bytes(self.data[0:32])

    def paths(self) -> list[list[tuple[int, str]]]:
        """For every leaf, level by level, its position in its run and the others' digests."""
        runs = [[self.run(level, i) for i in range(self.width(level + 1))] for level in range(self.height)]
        out = []
        for i in range(self.count):
            path = []
            for level in range(self.height):
                at = i >> BITS * level
                own = at & ARITY - 1
                run = runs[level][at >> BITS]
                path.append((own, "".join(run[:own] + run[own + 1 :])))
            out.append(path)
        return out


def fold(leaf: str, path: list[tuple[int, str]]) -> str:
    """The root that a leaf and the siblings on its path give."""
    for pos, siblings in path:
        leaf = hash_hex(siblings[: 64 * pos], leaf, siblings[64 * pos :])
    return leaf


def digest(fields: list[Column]) -> Column:
    """H of the fields: ``-`` for null, else UTF-8 byte count, colon, value."""
    one = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in (f.cast("string") for f in fields)]
    return F.unhex(F.sha2(F.concat(*one), 256))


def leaf_rows(docs: DataFrame, presented: Column | None = None, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(id, grp, leaf, shown): each row's digest, and that of the row with ``presented``
    as its text where it is another."""
    other = digest([presented if f == "text" else F.col(f) for f in fields]) if presented is not None else F.lit(None).cast("binary")
    if presented is not None:
        other = F.when(presented.eqNullSafe(F.col("text")), None).otherwise(other)
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("grp"), digest([F.col(f) for f in fields]).alias("leaf"), other.alias("shown"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with idx, the place among the rows of its grp by ``order``, and total, their number."""
    by = ["grp", *order, "tie"]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = land(dealt.drop("tie").withColumn("part", F.spark_partition_id()).withColumn("at", at), "merkle-placed")
    spans = placed.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy("grp")
    before = F.sum("n").over(group.orderBy("part")) - F.col("n")
    spans = spans.select(F.col("grp").alias("sg"), F.col("part").alias("sp"), (before - F.col("first")).alias("shift"), F.sum("n").over(group).alias("total"))
    joined = placed.join(spans, (F.col("part") == F.col("sp")) & F.col("grp").eqNullSafe(F.col("sg")))
    return joined.withColumn("idx", F.col("at") + F.col("shift")).drop("sg", "sp", "part", "at", "shift")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """One row a block of the nodes (grp, idx, total, leaf, and for documents id, shown)."""
    fields = [c for c in ("idx", "leaf", "id", "shown") if c in nodes.columns]
    items = nodes.groupBy("grp", F.shiftright("idx", BITS * HEIGHT).alias("block"), "total").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("items"))
    kept = [F.col("items")[f].alias(f"{f}s") for f in fields if f != "idx"]
    schema = "grp string, block long, total long, data binary" + ("" if "id" not in fields else ", ids array<long>, showns array<binary>")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for i in range(batch.num_rows):
                leaves = batch.column("leafs")[i].as_py()
                data.append(bytes(Block.of(leaves, batch.column("total")[i].as_py()).data))
            rest = {c: batch.column(c) for c in batch.schema.names if c != "leafs"}
            rest["data"] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_pydict({c: rest[c] for c in names})

    names = [x.split()[0] for x in schema.split(", ")]
    return land(items.select("grp", "block", "total", *kept).mapInArrow(step, schema), name)


def tiers(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The blocks of every tier, from the leaves' up."""
    out = [_blocks(nodes, f"merkle-{name}")]
    while True:
        more = out[-1].where(F.col("total") > ARITY**HEIGHT)
        if more.isEmpty():
            return out
        up = more.select("grp", F.col("block").alias("idx"), F.ceil(F.col("total") / ARITY**HEIGHT).cast("long").alias("total"), F.substring("data", 1, 32).alias("leaf"))
        out.append(_blocks(up, f"merkle-{name}"))


def roots(built: list[DataFrame]) -> DataFrame:
    """(grp, leaf): the root of every group."""
    tops = [b.where(F.col("total") <= ARITY**HEIGHT).select("grp", F.substring("data", 1, 32).alias("leaf")) for b in built]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _paths(blocks: DataFrame) -> DataFrame:
    """Of blocks with a path to the root: (grp, block, node, path) for each leaf of theirs,
    the block below; columns root and subroot pass through."""
    carry = [c for c in ("root", "subroot") if c in blocks.columns]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                b = Block(height_of(row["total"]), _count(row), row["data"])
                above = row["path"]
                paths = [[{"pos": p, "siblings": bytes.fromhex(s)} for p, s in own] + above for own in b.paths()]
                first = row["block"] * ARITY**HEIGHT
                out = {
                    "grp": pa.array([row["grp"]] * b.count, pa.string()),
                    "block": pa.array(range(first, first + b.count), pa.int64()),
                    "node": pa.array([bytes.fromhex(b.node(0, i)) for i in range(b.count)], pa.binary()),
                    "path": pa.array(paths, pa.list_(pa.struct([("pos", pa.int32()), ("siblings", pa.binary())]))),
                } | {c: pa.array([row[c]] * b.count, pa.binary()) for c in carry}
                yield pa.RecordBatch.from_pydict(out)

    schema = f"grp string, block long, node binary, path {_STEP}" + "".join(f", {c} binary" for c in carry)
    return blocks.select("grp", "block", "total", "data", "path", *carry).mapInArrow(step, schema)


def _count(row: dict) -> int:
    """Leaves of a block: all of its tree's nodes that fall into it."""
    return min(ARITY**HEIGHT, row["total"] - row["block"] * ARITY**HEIGHT)


def _with_path(blocks: DataFrame, above: DataFrame) -> DataFrame:
    a = above.select(F.col("grp").alias("ag"), F.col("block").alias("ab"), *[c for c in above.columns if c not in ("grp", "block")])
    return blocks.join(a, (F.col("block") == F.col("ab")) & F.col("grp").eqNullSafe(F.col("ag"))).drop("ag", "ab")


def proofs(docs: DataFrame, presented: Column | None = None) -> DataFrame:
    """Every row's leaf, its group's and the table's root, the digest of its proof, and
    what the presented row and the proof give: (doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified)."""
    leaves = land(leaf_rows(docs, presented), "merkle-leaves")
    forest = tiers(ranked(leaves, ["id", "leaf"]), "rows")
    groups = land(roots(forest), "merkle-roots")
    by_lang = ranked(groups.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "leaf"), ["name"])
    by_lang = land(by_lang, "merkle-groups")
    upper = tiers(by_lang.select("grp", "idx", "total", "leaf"), "groups")

    # From the root down to the groups, then to the documents' blocks.
    above = None
    for blocks in reversed(upper):
        if above is None:
            held = blocks.withColumn("path", F.array().cast(_STEP)).withColumn("root", F.substring("data", 1, 32))
        else:
            held = _with_path(blocks, above.drop("node"))
        above = _paths(held)
    named = above.join(by_lang.select(F.col("idx").alias("block"), "name"), "block")
    named = land(named.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"), F.col("node").alias("subroot"), "root", "path"), "merkle-tops")
    carried = None
    for blocks in reversed(forest):
        start = _with_path(blocks.where(F.col("total") <= ARITY**HEIGHT), named)
        if carried is not None:
            start = start.unionByName(_with_path(blocks.where(F.col("total") > ARITY**HEIGHT), carried.drop("node")))
        if blocks is not forest[0]:
            carried = land(_paths(start), "merkle-paths")
    return start.mapInArrow(_report, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            b = Block(height_of(row["total"]), _count(row), row["data"])
            above = [(s["pos"], s["siblings"].hex()) for s in row["path"]]
            tail = "".join(s for _, s in above)
            subroot, root = row["subroot"].hex(), row["root"].hex()
            leaf, proof, folded = [], [], []
            for i, own in enumerate(b.paths()):
                shown = row["showns"][i]
                leaf.append(b.node(0, i))
                proof.append(hash_hex(*(s for _, s in own), tail))
                folded.append(fold(shown.hex() if shown is not None else leaf[-1], own + above))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(row["ids"], pa.int64()),
                    "leaf": pa.array(leaf),
                    "subroot": pa.array([subroot] * b.count),
                    "root": pa.array([root] * b.count),
                    "proof_sha256": pa.array(proof),
                    "folded_root": pa.array(folded),
                    "verified": pa.array([f == root for f in folded]),
                }
            )
