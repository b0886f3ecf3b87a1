"""Operator 2: WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole WARC
records, closed by a footer: a skippable frame with the seek table (compressed and
plain size of every frame) as the public seekable format lays it out.  Any Zstandard
tool reads a bundle as one stream; a reader with the seek table opens one frame.

Writers run in the tasks of one partition each, through the file system that the
folder's scheme names, under a name no other attempt uses.  The index they return
(record id -> bundle, frame, offset in the frame, length) is a written table: only
files of tasks that succeeded are in it, so a lost executor leaves at most an
unlisted file behind.

Defined results: a null html is an empty payload; payloads under ``MIN_REVISIT``
bytes are never revisits; of equal payloads the smallest page_id responds (of
repeated rows with that page_id each is a response); a null page_id sorts last
and is never referred to while a numbered page has the payload; extra columns are
ignored; an empty table writes no bundle.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import land, new_path

MIN_REVISIT = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 1
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, record_id string, record_type string, bundle string, frame int, frame_at long, frame_bytes long, offset long, length long"


def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> tuple[str, bytes]:
    """(record id, bytes) of a response, or of a revisit of ``refers_to``, which has no payload."""
    name = f"urn:page:{'' if page_id is None else page_id}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if refers_to is not None else http + payload
    target = re.sub(r"[\r\n]+", " ", url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return name, "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's headers and payload; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    name, refers = (fields.get(k, "").removeprefix("<urn:page:").removesuffix(">") for k in ("WARC-Record-ID", "WARC-Refers-To"))
    return {
        "page_id": int(name) if name else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(refers) if refers else None,
        "payload": payload,
        "url": fields["WARC-Target-URI"],
    }


def footer(frames: list[tuple[int, int]]) -> bytes:
    table = b"".join(struct.pack("<II", *x) for x in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(table)) + table


def read_footer(f, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame."""
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * n)
    at, out = 0, []
    for packed, plain in struct.iter_unpack("<II", f.read(8 * n)):
        out.append((at, packed, plain))
        at += packed
    return out


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if re.match(r"[a-z][a-z0-9+.-]*:", uri) else "file://" + uri)


def revisit_plan(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): every row, with the page it revisits."""
    text = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), text.alias("html"), F.sha2(text.cast("binary"), 256).alias("digest"))
    shared = (
        pages.select(F.col("page_id").cast("long"), F.sha2(text.cast("binary"), 256).alias("digest"), F.octet_length(text).alias("n"))
        .where(F.col("n") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    joined = rows.join(land(shared, "warc-shared"), "digest", "left")
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write every page as a record below ``folder``; returns the index."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        state: dict = {"out": None}
        ready: list[dict] = []

        def close_frame() -> None:
            if not state["plain"]:
                return
            data = press.compress(b"".join(state["plain"]))
            state["out"].write(data)
            for row in state["rows"]:
                ready.append(row | {"frame": len(state["frames"]), "frame_at": state["at"], "frame_bytes": len(data)})
            state["frames"].append((len(data), state["size"]))
            state["at"] += len(data)
            state.update(plain=[], rows=[], size=0)

        def close_bundle() -> None:
            if state["out"] is None:
                return
            close_frame()
            state["out"].write(footer(state["frames"]))
            state["out"].close()
            state["out"] = None

        for batch in batches:
            for row in batch.to_pylist():
                if state["out"] is None:
                    name = f"bundle-{uuid.uuid4().hex}.warc.zst"
                    fs.create_dir(base, recursive=True)
                    state.update(out=fs.open_output_stream(f"{base}/{name}", compression=None), name=name, at=0, frames=[], plain=[], rows=[], size=0)
                record_id, data = record(row["page_id"], row["url"], row["html"].encode("utf-8"), row["digest"], row["refers_to"])
                state["rows"].append({"page_id": row["page_id"], "record_id": record_id, "record_type": "response" if row["refers_to"] is None else "revisit", "bundle": state["name"], "offset": state["size"], "length": len(data)})
                state["plain"].append(data)
                state["size"] += len(data)
                if state["size"] >= frame_bytes:
                    close_frame()
                if state["at"] >= bundle_bytes:
                    close_bundle()
            yield from emit(ready)
        close_bundle()
        yield from emit(ready)

    def emit(ready: list[dict]) -> Iterator[pa.RecordBatch]:
        if ready:
            cols = [x.split()[0] for x in INDEX.split(", ")]
            kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
            yield pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in ready], kinds[x.split()[1]]) for c, x in zip(cols, INDEX.split(", "))})
            ready.clear()

    return land(revisit_plan(pages).mapInArrow(step, INDEX), "warc-index")


def read_bundles(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records the index lists, read back from their frames.

    A task gets whole frames (a frame is bounded by ``frame_bytes`` and one record)
    and decompresses each once."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    frames = index.groupBy("bundle", "frame", "frame_at", "frame_bytes").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        plain = zstandard.ZstdDecompressor()
        handles: dict = {}
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] not in handles:
                    for h, _ in handles.values():
                        h.close()
                    handles.clear()
                    path = f"{base}/{row['bundle']}"
                    f = fs.open_input_file(path)
                    handles[row["bundle"]] = f, read_footer(f, f.size())
                f, frames_of = handles[row["bundle"]]
                at, packed, size = frames_of[row["frame"]]
                if (at, packed) != (row["frame_at"], row["frame_bytes"]):
                    raise ValueError("index and seek table disagree")
                f.seek(at)
                data = plain.decompress(f.read(packed), max_output_size=size)
                found = [parse(data[x["offset"] : x["offset"] + x["length"]]) for x in row["records"]]
                yield pa.RecordBatch.from_pydict({n: pa.array([x[n] for x in found], {"payload": pa.binary(), "record_type": pa.string(), "payload_digest": pa.string()}.get(n, pa.int64())) for n in names})

    return frames.mapInArrow(step, schema)


def read_record(index: DataFrame, folder: str, page_id: int) -> dict:
    """One record by its identifier: one frame is read and decompressed."""
    at = index.where(F.col("page_id") == page_id).first()
    fs, base = open_fs(folder)
    with fs.open_input_file(f"{base}/{at['bundle']}") as f:
        start, packed, size = read_footer(f, f.size())[at["frame"]]
        f.seek(start)
        data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=size)
    return parse(data[at["offset"] : at["offset"] + at["length"]])


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages below a new shared folder and read every record back."""
    folder = new_path(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, folder), folder)
