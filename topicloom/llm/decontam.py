"""Operator 5: benchmark decontamination with a generalised suffix automaton.

Items are normalised to words; one suffix automaton holds all items of a block,
separated by words that no document has.  A document's words stream through it;
the state and the longest matching length say which windows of an item end here.

A block is bounded (``block_words``), so the automaton that goes to the workers is
too.  A benchmark with more words makes several blocks: rows pass from one block
to the next through a written table, collecting hits on the way; an item longer
than a block is cut with an overlap of a window less one word, which keeps every
window whole.

Defined results: null or wordless texts have no words and no hits; null or wordless
items match nothing; rows with one doc_id stay separate rows; items sharing an
item_id count once, a null item_id is written ``null``; empty tables give no rows
(documents) or no hits (benchmark); other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StructField, StructType

from topicloom.llm.common import land

WINDOW = 10
BLOCK_WORDS = 200_000

_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Every byte to its lower-case word byte, or to a space.
FOLD = bytes(
    (b | 0x20 if 0x41 <= b <= 0x5A else b) if (b in _WORD_BYTES or 0x41 <= b <= 0x5A) else 0x20 for b in range(256)
)
_SPANS = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(FOLD).split() if text else []


class Automaton:
    """Suffix automaton of a block of items, with what is needed at match time."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]
        self.owner: list[set[str]] = [set()]
        last, separator, short = 0, -1, []
        for name, words in items:
            if not words:
                continue
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            for w in ids:
                last = self._extend(last, w)
                self.owner[last].add(name)
            last = self._extend(last, separator)
            separator -= 1
            if len(ids) < window:
                short.append((name, ids))
        self._finish(short)

    def _extend(self, last: int, w: int) -> int:
        new = self._state(self.len[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
            return new
        q = self.next[p][w]
        if self.len[q] == self.len[p] + 1:
            self.link[new] = q
            return new
        copy = self._state(self.len[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy] = self.link[q]
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        self.link[q] = self.link[new] = copy
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.len.append(length)
        self.owner.append(set())
        return len(self.next) - 1

    def _finish(self, short: list[tuple[str, list[int]]]) -> None:
        """at[s]: the state of the last ``window`` words of any match of at least that
        length in s; owner[at]: the items with that window; ends[s]: whole short items."""
        n, win = len(self.next), self.window
        order = sorted(range(n), key=self.len.__getitem__)
        for s in reversed(order):
            up = self.link[s]
            if up > 0 and self.len[up] >= win:
                self.owner[up] |= self.owner[s]
        self.at = [-1] * n
        for s in order:
            if self.len[s] >= win:
                self.at[s] = s if self.len[self.link[s]] < win else self.at[self.link[s]]
        keep = set(self.at)
        self.owner = [self.owner[s] if s in keep else None for s in range(n)]
        self.ends: dict[int, list[tuple[int, str]]] = {}
        for name, ids in short:
            s = 0
            for w in ids:
                s = self.next[s][w]
            self.ends.setdefault(s, []).append((len(ids), name))
        self.above = [0] * n  # the nearest state up the links (or s itself) with a whole short item
        for s in order[1:]:
            self.above[s] = s if s in self.ends else self.above[self.link[s]]
        self.shortest = min([win, *(len(ids) for _, ids in short)])

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges (from, to) of all occurring windows, merged, and their items."""
        get, nxt, link, length = self.vocab.get, self.next, self.link, self.len
        s = l = 0
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        least, win = self.shortest, self.window
        root = nxt[0]
        for p, w in enumerate(map(get, words)):
            if w is None:
                s = l = 0
                continue
            go = nxt[s].get(w)
            if go is None:
                while s:
                    s = link[s]
                    go = nxt[s].get(w)
                    if go is not None:
                        l = length[s]
                        break
                else:
                    go, l = root[w], 0
            s = go
            l += 1
            if l >= least:
                first = p + 1
                if l >= win:
                    first = p + 1 - win
                    items |= self.owner[self.at[s]]
                t = self.above[s]
                while t:
                    for size, name in self.ends[t]:
                        if size <= l:
                            first = min(first, p + 1 - size)
                            items.add(name)
                    t = self.above[link[t]]
                if first <= p:
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, p + 1))
        return spans, items


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most ``block_words`` words, one block in memory at a time."""
    block, room = [], block_words
    for row in benchmark.select("item_id", "text").toLocalIterator():
        words = words_of(row["text"])
        name = "null" if row["item_id"] is None else str(row["item_id"])
        at = 0
        while at < len(words):
            part = words[at : at + max(room, window)]
            block.append((name, part))
            room -= len(part)
            if room <= 0:
                yield block
                block, room = [], block_words
            if at + len(part) >= len(words):
                break
            at += len(part) - window + 1
    if block:
        yield block


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs``' columns doc_id and text with n_words, spans (packed word ranges) and
    item_ids (sorted as strings) of all windows that occur."""
    spark = docs.sparkSession
    schema = "doc_id long, text string, n_words long, spans binary, item_ids array<string>"
    cur = docs.select(F.col("doc_id").cast("long"), "text", F.lit(0).cast("long").alias("n_words"), F.lit(b"").alias("spans"), F.array().cast("array<string>").alias("item_ids"))
    todo, made = blocks(benchmark, window, block_words), 0
    for block in todo:
        automaton = spark.sparkContext.broadcast(Automaton(block, window))

        def step(batches: Iterator[pa.RecordBatch], automaton=automaton) -> Iterator[pa.RecordBatch]:
            a = automaton.value
            for batch in batches:
                rows = batch.to_pydict()
                for i, text in enumerate(rows["text"]):
                    words = words_of(text)
                    rows["n_words"][i] = len(words)
                    spans, items = a.match(words)
                    if spans:
                        old = list(struct.iter_unpack("<qq", rows["spans"][i]))
                        rows["spans"][i] = b"".join(struct.pack("<qq", *x) for x in _merge(old + spans))
                        rows["item_ids"][i] = sorted({*rows["item_ids"][i], *items})
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("spans", pa.binary()), ("item_ids", pa.list_(pa.string()))]))

        if made:
            cur = land(cur, "decontam-block")
        cur = cur.mapInArrow(step, schema)
        made += 1
    return cur if made else _count_words(cur, schema)


def _count_words(cur: DataFrame, schema: str) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(words_of(t)) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("n_words")
            yield batch.set_column(at, "n_words", pa.array(n, pa.int64()))

    return cur.mapInArrow(step, schema)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = find_hits(docs, benchmark, window, block_words)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("item_ids").to_pylist()
            n_hit = [sum(y - x for x, y in struct.iter_unpack("<qq", s)) for s in b.column("spans").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": b.column("doc_id"),
                    "n_words": b.column("n_words"),
                    "n_hit": pa.array(n_hit, pa.int64()),
                    "n_items": pa.array(map(len, ids), pa.int64()),
                    "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids],
                    "contaminated": [n > 0 for n in n_hit],
                }
            )

    return hits.drop("text").mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the ranges and what stands between them."""
    data = text.encode("utf-8")
    at = [m.span() for m in _SPANS.finditer(data.translate(FOLD))]
    out, done = [], 0
    for a, b in spans:
        out.append(data[done : at[a][0]])
        done = at[b - 1][1]
    out.append(data[done:])
    return b"\n".join(x for x in (y.strip() for y in out) if x).decode("utf-8")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.8, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with every occurring window cut out of its text; documents of which the
    windows cover ``max_coverage`` of the words or more are dropped.

    A round finds the windows of all blocks on the text as it is, then cuts them at once
    or drops the document; rounds are repeated on the rows that were cut until none has a
    window left (a cut may bring words together).  The number and order of blocks make no
    difference.  Columns and clean rows stay as they are."""
    todo = blocks(benchmark, window, block_words)
    block = next(todo, None)
    if block is None:
        return docs
    if next(todo, None) is None:
        return _remove_by_one(docs, Automaton(block, window), max_coverage)
    spark, names = docs.sparkSession, docs.columns
    at_text, n = names.index("text"), len(names)
    schema = StructType([*docs.schema.fields, StructField("__leak_spans", BinaryType()), StructField("__leak_cut", BooleanType())])

    def find(automaton):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a = automaton.value
            for batch in batches:
                spans = batch.column(n).to_pylist()
                for i, text in enumerate(batch.column(at_text).to_pylist()):
                    got, _ = a.match(words_of(text))
                    if got:
                        spans[i] = b"".join(struct.pack("<qq", *x) for x in _merge([*struct.iter_unpack("<qq", spans[i]), *got]))
                yield batch.set_column(n, batch.schema.field(n), pa.array(spans, batch.schema.field(n).type))

        return step

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep, changed = batch.column(at_text).to_pylist(), [], []
            for i, packed in enumerate(batch.column(n).to_pylist()):
                spans = list(struct.iter_unpack("<qq", packed))
                # As with one block, only the first round can drop a document.
                first = batch.column(n + 1)[i].as_py() is None
                keep.append(not (spans and first) or sum(y - x for x, y in spans) < max_coverage * len(words_of(texts[i])))
                changed.append(bool(spans))
                if spans and keep[-1]:
                    texts[i] = cut(texts[i], spans)
            batch = batch.set_column(at_text, batch.schema.field(at_text), pa.array(texts, batch.schema.field(at_text).type))
            batch = batch.set_column(n, batch.schema.field(n), pa.array([b""] * len(keep), batch.schema.field(n).type))
            batch = batch.set_column(n + 1, batch.schema.field(n + 1), pa.array(changed, pa.bool_()))
            yield batch.filter(pa.array(keep, pa.bool_()))

    done = None
    cur = docs.select(*names, F.lit(b"").alias("__leak_spans"), F.lit(None).cast("boolean").alias("__leak_cut"))
    while True:
        for block in blocks(benchmark, window, block_words):
            automaton = spark.sparkContext.broadcast(Automaton(block, window))
            cur = land(cur.mapInArrow(find(automaton), schema), "decontam-block")
            automaton.unpersist()
        cur = land(cur.mapInArrow(cut_all, schema), "decontam-cut")
        settled = cur.where("not __leak_cut").select(*names)
        done = settled if done is None else done.unionByName(settled)
        cur = cur.where("__leak_cut")
        if cur.isEmpty():
            return done


def _remove_by_one(docs: DataFrame, automaton: Automaton, max_coverage: float) -> DataFrame:
    """The rounds of ``remove_leaks`` where one block holds the benchmark: in one pass."""
    at_text = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        for batch in batches:
            texts, keep = batch.column(at_text).to_pylist(), []
            changed = False
            for i, text in enumerate(texts):
                words = words_of(text)
                spans, _ = a.match(words)
                keep.append(not spans or sum(y - x for x, y in spans) < max_coverage * len(words))
                while spans and keep[-1]:
                    texts[i], changed = cut(texts[i], spans), True
                    spans, _ = a.match(words_of(texts[i]))
            if changed:
                batch = batch.set_column(at_text, batch.schema.field(at_text), pa.array(texts, batch.schema.field(at_text).type))
            yield batch if all(keep) else batch.filter(pa.array(keep))

    return docs.mapInArrow(step, docs.schema)
