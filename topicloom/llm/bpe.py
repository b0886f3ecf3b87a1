"""Operator 1: byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its encoding.
``last[i]`` stores that token for the first i bytes: it is the token t that ends at
i and is stable beside ``last[i - len(t)]`` -- encoding the two tokens' bytes gives
the two tokens again.  The encoding is read off backwards.  As ``last`` of a prefix
never changes, bytes can be appended exactly, and after an edit only entries until
the table agrees with the old one again are recomputed (``PrefixEncoding``).

The pieces of a slice of texts that are new to a worker are encoded in sorted order, so
each starts from the table of the bytes it shares with the one before.

The vocabulary file is read by the driver and broadcast; its size is checked
against ``MAX_VOCAB_BYTES``.  Texts are encoded row by row in Arrow batches, without
a shuffle, so a hot source, copies or long texts move no data.

Defined results: a null text is an empty one (no ids); rows with equal or null
doc_id stay separate rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_VOCAB_BYTES = 64 << 20
#: Entries and characters of a worker's piece cache, entries of its pair cache; a full cache is emptied.
CACHE_PIECES = 250_000
CACHE_CHARS = 16 << 20
CACHE_PAIRS = 400_000
#: Pieces encoded at a time, so a very long text needs no list of all its pieces.
CHUNK = 200_000


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class PrefixBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        size = max(ranks.values()) + 1
        self.token = [b""] * size
        for t, r in ranks.items():
            self.token[r] = t
        #: Every suffix of a token: its rank, or -1 if it is no token itself.
        self.known = dict.fromkeys((t[i:] for t in ranks for i in range(1, len(t))), -1) | ranks
        self.stable: dict[tuple[int, int], bool] = {}
        self.own: dict[int, bool] = {}
        self.spines: dict[tuple[int, bool], tuple[int, ...] | None] = {}
        self.pieces: dict[str, bytes] = {}
        self.chars = 0

    def merge(self, data: bytes, least: int = 1) -> list[int]:
        """The definition: join the neighbours of lowest rank, leftmost first, until none has a
        rank (or ``least`` parts are left)."""
        get, none = self.ranks.get, len(self.token)
        parts = [data[i : i + 1] for i in range(len(data))]
        joined = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while len(parts) > least:
            best = min(joined)
            if best == none:
                break
            i = joined.index(best)
            parts[i : i + 2] = [self.token[best]]
            del joined[i]
            if i:
                joined[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(joined):
                joined[i] = get(parts[i] + parts[i + 1], none)
        return [self.ranks[p] for p in parts]

    def _alone(self, t: int) -> bool:
        ok = self.own.get(t)
        if ok is None:
            ok = self.own[t] = self.merge(self.token[t]) == [t]
        return ok

    def _beside(self, a: int, b: int) -> bool:
        ok = self.stable.get((a, b))
        if ok is None:
            if len(self.stable) >= CACHE_PAIRS:
                self.stable.clear()
            ok = self.stable[a, b] = self._keeps_apart(a, b)
        return ok

    def _spine(self, t: int, right: bool) -> tuple[int, ...] | None:
        """The parts of t at its left or right end while t is merged, from a byte up to t.
        None if t isn't made by merges, or not by merges of rising rank."""
        key = t, right
        if key not in self.spines:
            found: tuple[int, ...] | None = (t,)
            if len(self.token[t]) > 1:
                ends = self.merge(self.token[t], least=2)
                below = self._spine(ends[right and -1], right) if len(ends) == 2 else None
                rising = all(e < t or len(self.token[e]) == 1 for e in ends)
                found = below + found if below and rising else None
            self.spines[key] = found
        return self.spines[key]

    def _keeps_apart(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives [a, b]: no pair of parts that meet
        between them is merged before one of the two parts is."""
        left, right = self._spine(a, True), self._spine(b, False)
        if left is None or right is None:
            return self.merge(self.token[a] + self.token[b]) == [a, b]
        get, token, never = self.ranks.get, self.token, len(self.token)
        i = j = 0
        while True:
            next_a = left[i + 1] if i + 1 < len(left) else never
            next_b = right[j + 1] if j + 1 < len(right) else never
            across = get(token[left[i]] + token[right[j]], never)
            if across < next_a and across <= next_b:  # of equal ranks the leftmost merges first
                return False
            if next_a == next_b == never:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[int], until: int) -> None:
        """Append the entries of ``last`` up to prefix length ``until``; last[0] is -1."""
        known, stable = self.known.get, self.stable.get
        for i in range(len(last), until + 1):
            ends = []
            for j in range(i - 1, -1, -1):
                t = known(data[j:i])
                if t is None:
                    break
                if t >= 0:
                    ends.append((j, t))
            for j, t in reversed(ends):
                if j:  # a token that is stable beside another is stable alone
                    ok = stable((last[j], t))
                    if ok is None:
                        ok = self._beside(last[j], t)
                else:
                    ok = self._alone(t)
                if ok:
                    last.append(t)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte of the text")

    def walk_back(self, last: list[int], at: int) -> list[int]:
        out = []
        while at:
            out.append(last[at])
            at -= len(self.token[last[at]])
        return out[::-1]

    def learn(self, pieces: Iterable[str]) -> None:
        """Put the ids of all these pieces into the cache, as little-endian unsigned 32-bit integers."""
        wanted = set(pieces)
        new = wanted.difference(self.pieces)
        if len(self.pieces) + len(new) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self.pieces.clear()
            self.chars, new = 0, wanted
        before, last = b"", [-1]
        for piece in sorted(new):
            data = piece.encode("utf-8")
            whole = self.ranks.get(data)
            if whole is not None:  # a piece that is a token is that token, whatever its merges say
                ids = [whole]
            else:
                shared, most = 0, min(len(before), len(data))
                while shared < most and before[shared] == data[shared]:
                    shared += 1
                del last[shared + 1 :]
                self.extend(data, last, len(data))
                ids, before = self.walk_back(last, len(data)), data
            self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
            self.chars += len(piece)

    def packed(self, pieces: list[str]) -> bytes:
        try:
            return b"".join(map(self.pieces.__getitem__, pieces))
        except KeyError:
            self.learn(pieces)
            return b"".join(map(self.pieces.__getitem__, pieces))

    def split(self, text: str) -> Iterable[list[str]]:
        """The pieces of ``text``; of a very long one, some at a time."""
        if len(text) <= 4 * CHUNK:
            return [self.pattern.findall(text)]
        found = (m[0] for m in self.pattern.finditer(text))
        return iter(lambda: list(islice(found, CHUNK)), [])

    def encode_packed(self, text: str) -> Iterator[bytes]:
        """Ids of ``text`` as little-endian unsigned 32-bit integers, in chunks."""
        return map(self.packed, self.split(text))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.encode_packed(text)), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class PrefixEncoding:
    """The table of one piece: exact appends, cuts and edits."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, data, [-1]
        bpe.extend(data, self.last, len(data))
        self.reach = max(map(len, bpe.ranks))

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for bytes start to end; returns how many entries were computed anew.

        Entries up to ``start`` stay.  Behind the edit an entry depends on the longest
        token's bytes and entries before it, so once that many entries in a row agree
        with the old table, all the rest does too."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        i, same = start + 1, 0
        while i <= len(self.data):
            self.bpe.extend(self.data, self.last, i)
            before = i - shift
            same = same + 1 if i > start + len(new) + self.reach and self.last[i] == old[before] else 0
            i += 1
            if same >= self.reach:
                self.last += old[i - shift :]
                break
        return i - start - 1

    def ids(self) -> list[int]:
        return self.bpe.walk_back(self.last, len(self.data))


_ENCODERS: dict[str, PrefixBpe] = {}


def encoder(data: bytes, pattern: str) -> PrefixBpe:
    """One encoder, and so one cache, for each worker and vocabulary."""
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PrefixBpe(parse_ranks(data), pattern)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, token_ids]) of every document."""
    with open(vocabulary, "rb") as f:
        data = f.read(MAX_VOCAB_BYTES + 1)
    if len(data) > MAX_VOCAB_BYTES:
        raise ValueError("vocabulary too large to broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(data)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value, pattern)
        for batch in batches:
            # A slice at a time: ids of a batch take more room than its texts.
            sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0)))
            cuts = np.flatnonzero(np.diff(sizes // (2 << 20), prepend=0)).tolist() if len(sizes) else []
            for lo, hi in zip([0, *cuts], [*cuts, len(sizes)]):
                if hi > lo:
                    yield encode_slice(bpe, batch.slice(lo, hi - lo))

    def encode_slice(bpe: PrefixBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        count, ids_hex, text_hex, kept = [], [], [], []
        pieces = [bpe.split(text or "") for text in batch.column("text").to_pylist()]
        bpe.learn(p for chunks in pieces if isinstance(chunks, list) for p in chunks[0])
        for chunks in pieces:
            ids, plain, n = hashlib.sha256(), hashlib.sha256(), 0
            for packed in map(bpe.packed, chunks):
                ids.update(packed)
                array = np.frombuffer(packed, "<u4")
                plain.update(bpe.decode(array.tolist()))
                n += len(array)
                if with_ids:
                    kept.append(array)
            count.append(n)
            ids_hex.append(ids.hexdigest())
            text_hex.append(plain.hexdigest())
        out = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(count, pa.int64()), "ids_sha256": ids_hex, "decoded_sha256": text_hex}
        if with_ids:
            values = np.concatenate([np.empty(0, "<u4"), *kept]).astype(np.int32)
            out["token_ids"] = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(count)]).astype(np.int32), values)
        return pa.RecordBatch.from_pydict(out)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(step, schema)
