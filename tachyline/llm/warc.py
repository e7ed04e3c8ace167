"""WARC archives as seekable Zstandard bundles, written by Spark and read back by record identifier.

A bundle is one file: independent Zstandard frames of a few records each, then the seek table of the public
seekable format in a skippable frame: for each frame its compressed and plain size, and a footer with the number
of frames. The index maps a record identifier to bundle, frame and offset within the plain frame, so one frame is
decompressed to read a record. Bundles are rows with a binary column, written as a table by Spark's own writers,
so they can live in any store; ``export`` turns them into files on a mounted file system.

Of records with equal payloads of ``least`` bytes or more the smallest identifier is the response and the others
revisit it. Payloads are grouped by digest, and only the smallest identifier is gathered per group.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, materialize

FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 8 << 20
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the format
DATE = "1970-01-01T00:00:00Z"
BUNDLE = "bundle string, n_records long, data binary, ids binary, frames binary, offsets binary"


def record(page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One WARC/1.1 record. A revisit has no block; its payload is that of the record it refers to."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Refers-To-Target-URI: {_line(refers_url)}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _line(url: str | None) -> str:
    """A header's value can't hold line ends; they are percent-encoded."""
    return (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if url and ("\r" in url or "\n" in url) else url or ""


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, data[start:stop], stop + 4


def seal(frames: list[tuple[int, int]]) -> bytes:
    """The seek table for frames of (compressed, plain) sizes, as a skippable frame."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the footer."""
    n, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    at, out = len(bundle) - 9 - 8 * n, []
    start = 0
    for k in range(n):
        packed, plain = struct.unpack_from("<II", bundle, at + 8 * k)
        out.append((start, packed, plain))
        start += packed
    return out


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    start, packed, plain = frame
    return zstandard.ZstdDecompressor().decompress(bundle[start : start + packed], max_output_size=max(plain, 1)) if plain else b""


def _pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records -> bundles. Only the open bundle is held."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
    task, serial = TaskContext.get().partitionId(), 0
    frame, frames, data, index, ids = bytearray(), [], bytearray(), [], []

    def close_frame() -> None:
        nonlocal frame
        if frame:
            packed = packer.compress(bytes(frame))
            frames.append((len(packed), len(frame)))
            data.extend(packed)
            frame = bytearray()

    def close() -> pa.RecordBatch:
        nonlocal serial, frames, data, index, ids
        close_frame()
        out = pa.RecordBatch.from_arrays([pa.array([f"part-{task:06d}-{serial:05d}.warc.zst"]), pa.array([len(ids)], pa.int64()), pa.array([bytes(data) + seal(frames)], pa.binary()), pa.array([struct.pack(f"<{len(ids)}q", *ids)], pa.binary()), pa.array([struct.pack(f"<{len(ids)}I", *(i[0] for i in index))], pa.binary()), pa.array([struct.pack(f"<{len(ids)}I", *(i[1] for i in index))], pa.binary())], ["bundle", "n_records", "data", "ids", "frames", "offsets"])
        serial += 1
        frames, data, index, ids = [], bytearray(), [], []
        return out

    for part in parts:
        columns = (part.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to", "refers_url"))
        for page_id, url, html, digest, refers_to, refers_url in zip(*columns, strict=True):
            item = record(page_id, url, (html or "").encode(), digest, refers_to, refers_url)
            if frame and len(frame) + len(item) > FRAME_BYTES:
                close_frame()
            ids.append(page_id)
            index.append((len(frames), len(frame)))
            frame += item
            if len(data) + len(frame) > BUNDLE_BYTES:
                yield close()
    if ids:
        yield close()


def bundles(pages: DataFrame, least: int = 100) -> DataFrame:
    """``pages`` (page_id, url, html, ...) -> bundles (``BUNDLE``), not yet written.

    Null html is an empty payload; rows without page_id aren't archived. Rows that repeat a page_id are records
    of their own; with equal payloads they are responses all. Other columns are ignored.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.where("page_id is not null").select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"))
    named = pages.where("page_id is not null").select("page_id", "url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")).where(F.col("n") >= least).drop("n")
    first = named.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("times")).where("times > 1")
    # The payloads meet their references by page, not by digest, so copies of one page spread over all tasks.
    later = named.select("page_id", "digest").join(first, "digest").where("first.page_id < page_id").select("page_id", "digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url")).distinct()
    return rows.join(later, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to", "refers_url").transform(map_batches, _pack, BUNDLE)


def _records(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for bundle, ids, frames, offsets in zip(*(part.column(c).to_pylist() for c in ("data", "ids", "frames", "offsets")), strict=True):
            table, n = seek_table(bundle), len(ids) // 8
            keys, frame_of, offset_of = struct.unpack(f"<{n}q", ids), struct.unpack(f"<{n}I", frames), struct.unpack(f"<{n}I", offsets)
            out, held, plain = [], -1, b""
            for page_id, f, o in zip(keys, frame_of, offset_of, strict=True):
                if f != held:
                    held, plain = f, read_frame(bundle, table[f])
                headers, block, _ = parse(plain, o)
                if headers["WARC-Record-ID"] != f"<urn:page:{page_id}>":
                    raise ValueError(f"index and record differ at {page_id}")
                kind = headers["WARC-Type"]
                refers = int(headers["WARC-Refers-To"][10:-1]) if kind == "revisit" else None
                size = len(block) if refers is None else int(headers["X-Payload-Length"])
                digest = hashlib.sha256(block).hexdigest() if refers is None else headers["WARC-Payload-Digest"][7:]
                out.append((page_id, size, digest, kind, refers, headers["WARC-Target-URI"], block if refers is None else None))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()), strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])


def read_records(archive: DataFrame) -> DataFrame:
    """All records of bundles: page_id, payload_bytes, payload_digest (of the bytes read), record_type, refers_to, url, payload."""
    return archive.transform(map_batches, _records, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def index(archive: DataFrame) -> DataFrame:
    """page_id, bundle, frame, offset of every record."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for bundle, ids, frames, offsets in zip(*(part.column(c).to_pylist() for c in ("bundle", "ids", "frames", "offsets")), strict=True):
                n = len(ids) // 8
                yield pa.RecordBatch.from_arrays([pa.array(struct.unpack(f"<{n}q", ids), pa.int64()), pa.array([bundle] * n), pa.array(struct.unpack(f"<{n}I", frames), pa.int64()), pa.array(struct.unpack(f"<{n}I", offsets), pa.int64())], ["page_id", "bundle", "frame", "offset"])

    return archive.select("bundle", "ids", "frames", "offsets").transform(map_batches, run, "page_id long, bundle string, frame long, offset long")


def export(archive: DataFrame, folder: str) -> DataFrame:
    """Write each bundle as a file of a folder that all executors mount; returns (bundle, bytes). Runs when read."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for bundle, data in zip(part.column("bundle").to_pylist(), part.column("data").to_pylist(), strict=True):
                part_name = f"{folder}/.{bundle}.{TaskContext.get().taskAttemptId()}"
                with open(part_name, "wb") as f:
                    f.write(data)
                os.replace(part_name, f"{folder}/{bundle}")
                yield pa.RecordBatch.from_arrays([pa.array([bundle]), pa.array([len(data)], pa.int64())], ["bundle", "bytes"])

    return archive.select("bundle", "data").transform(map_batches, run, "bundle string, bytes long")


def op7_warc_bundles(spark, sf_dir: str) -> DataFrame:
    """Per page, read back from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    archive = materialize(bundles(spark.read.parquet(f"{sf_dir}/pages.parquet")), "warc")
    return read_records(archive).drop("url", "payload")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha256(h) AS d, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND first < page_id THEN first END AS refers_to
FROM q
"""
