"""Token identifiers of a corpus in files of directly addressable codes: any token is read without decoding a block.

An identifier is cut into chunks of whole half bytes, lowest first. Level one has the first chunk of every identifier
and a bitmap that says whose value goes on; level two has the next chunks of those that go on, and so forth. A directory
holds the number of set bits before each 512th bit, so the place on the next level is a table entry and a count within
64 bytes. How many half bytes a level takes is chosen for each file from its identifiers, for the least size.

Documents are dealt out by ranges of doc_id, sorted, encoded where they arrive and packed into files of about a
million tokens; a longer document is a file of its own. A file knows how many tokens come before it in its range, and
one row for each range holds what the earlier ranges have, so no task sees the corpus and positions are global.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import chunks, map_batches, materialize, texts_of
from .word_pieces import END_ID, WordEncoder

FILE_TOKENS = 1 << 20
BLOCK = 512  # bits for each entry of a rank directory
MAGIC = b"DAC1"
STORE = "part int, serial int, bundle string, before long, n_docs long, n_tokens long, data binary"
ONES = np.array([bin(k).count("1") for k in range(256)], np.uint8)


def level_sizes(ids: np.ndarray) -> list[int]:
    """Half bytes that each level takes, for the smallest file: a shortest path over the borders of half bytes.

    Identifiers of more than one byte have two levels at least.
    """
    longer = [len(ids), *(int(np.count_nonzero(ids >= np.uint32(1 << 4 * k))) for k in range(1, 8))]
    top = max([k + 1 for k in range(8) if longer[k]], default=1)
    best: dict[int, tuple[float, list[int]]] = {top: (0.0, [])}
    for at in range(top - 1, -1, -1):
        stops = [stop for stop in range(at + 1, top + 1) if stop - at < max(top, 3)]
        flag = {stop: 1 + 32 / BLOCK if stop < top else 0.0 for stop in stops}
        best[at] = min((longer[at] * (4 * (stop - at) + flag[stop]) + best[stop][0], [stop - at, *best[stop][1]]) for stop in stops)
    return best[0][1]


def _pack_halves(values: np.ndarray, size: int) -> bytes:
    halves = np.empty((len(values), size), np.uint8)
    for k in range(size):
        halves[:, k] = (values >> np.uint32(4 * k)) & np.uint32(15)
    halves = np.append(halves.ravel(), np.zeros(len(values) * size & 1, np.uint8))
    return (halves[::2] | halves[1::2] << 4).tobytes()


def _unpack_halves(data: memoryview, n: int, size: int) -> np.ndarray:
    packed, value = np.frombuffer(data, np.uint8), np.zeros(n, np.uint32)
    halves = np.empty(2 * len(packed), np.uint8)
    halves[::2], halves[1::2] = packed & 15, packed >> 4
    for k in range(size):
        value |= halves[k : n * size : size].astype(np.uint32) << np.uint32(4 * k)
    return value


def pack_codes(ids: np.ndarray) -> bytes:
    """Identifiers (unsigned, 32 bits) -> levels: header, then chunks, continuation bitmap and rank directory of each."""
    rest, sizes, out = ids.astype(np.uint32), level_sizes(ids), []
    out.append(struct.pack("<B", len(sizes)))
    for k, size in enumerate(sizes):
        chunks, flags, directory, n = _pack_halves(rest, size), b"", b"", len(rest)
        if k + 1 < len(sizes):
            more = rest >= np.uint32(1 << 4 * size)
            flags = np.packbits(more, bitorder="little").tobytes()
            counts = np.add.reduceat(more.astype(np.int64), np.arange(0, n, BLOCK)) if n else np.zeros(0, np.int64)
            directory = (np.cumsum(counts) - counts).astype("<u4").tobytes()
            rest = rest[more] >> np.uint32(4 * size)
        out += [struct.pack("<BIII", size, n, len(flags), len(directory)), chunks, flags, directory]
    return b"".join(out)


class Codes:
    """Read access to ``pack_codes``: one identifier by its place, or all of them."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        at, self.levels = 1, []
        for _ in range(data[0]):
            size, n, flags, directory = struct.unpack_from("<BIII", data, at)
            at += 13
            cuts = np.cumsum([at, (n * size + 1) // 2, flags, directory]).tolist()
            self.levels.append((size, n, data[cuts[0] : cuts[1]], data[cuts[1] : cuts[2]], data[cuts[2] : cuts[3]]))
            at = cuts[3]

    def __len__(self) -> int:
        return self.levels[0][1]

    def __getitem__(self, i: int) -> int:
        value = shift = 0
        for size, n, chunks, flags, directory in self.levels:
            if not 0 <= i < n:
                raise IndexError(i)
            first, odd = divmod(i * size, 2)
            value |= (int.from_bytes(chunks[first : first + size // 2 + 1], "little") >> 4 * odd & (1 << 4 * size) - 1) << shift
            if not flags or not flags[i >> 3] >> (i & 7) & 1:
                return value
            block, byte = i // BLOCK, i >> 3
            before = struct.unpack_from("<I", directory, 4 * block)[0]
            before += int(ONES[np.frombuffer(flags[block * BLOCK // 8 : byte], np.uint8)].sum())
            i = before + int(ONES[flags[byte] & (1 << (i & 7)) - 1])
            shift += 4 * size
        return value

    def all(self) -> np.ndarray:
        value = np.zeros(0, np.uint32)
        for size, n, chunks, flags, _ in reversed(self.levels):
            own = _unpack_halves(chunks, n, size)
            if flags:
                more = np.unpackbits(np.frombuffer(flags, np.uint8), count=n, bitorder="little").astype(bool)
                own[more] |= value << np.uint32(4 * size)
            value = own
        return value


def pack_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A file: magic, counts, identifiers of documents with a bit for those that are null, their token counts, codes."""
    known = np.packbits([d is not None for d in doc_ids], bitorder="little").tobytes()
    head = MAGIC + struct.pack("<IQ", len(doc_ids), len(ids))
    return head + known + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<u4").tobytes() + pack_codes(ids)


class TokenFile:
    """A file as it is read: ``doc_ids``, ``lengths`` (tokens of each) and ``codes``."""

    def __init__(self, data: bytes):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a file of token codes")
        n, self.n_tokens = struct.unpack_from("<IQ", data, 4)
        at = 16 + (n + 7) // 8
        known = np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, 16), count=n, bitorder="little")
        self.doc_ids = [d if k else None for d, k in zip(np.frombuffer(data, "<i8", n, at).tolist(), known.tolist(), strict=True)]
        self.lengths = np.frombuffer(data, "<u4", n, at + 8 * n).astype(np.int64)
        self.codes = Codes(memoryview(data)[at + 12 * n :])


def _encode(path: str, end_id: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = WordEncoder.of(path), TaskContext.get().partitionId()
        doc_ids, lengths, held, n, before, serial = [], [], [], 0, 0, 0
        end = np.array([end_id], np.uint32)

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, lengths, held, n, before, serial
            data = pack_file(doc_ids, lengths, np.concatenate(held))
            row = (task, serial, f"tokens-{task:06d}-{serial:06d}.dac", before, len(doc_ids), n, data)
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            doc_ids, lengths, held, before, n, serial = [], [], [], before + n, 0, serial + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], [c.split()[0] for c in STORE.split(", ")])

        for part in parts:
            keys = part.column("doc_id").to_pylist()
            data, offsets = texts_of(part.column("text"))
            for i, j in chunks(offsets):
                ids, counts = encoder.rows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                at = 0
                for doc_id, count in zip(keys[i:j], counts.tolist(), strict=True):
                    if n and n + count >= FILE_TOKENS:
                        yield close()
                    doc_ids.append(doc_id)
                    lengths.append(count + 1)
                    held += [ids[at : at + count], end]
                    n += count + 1
                    at += count
        if doc_ids:
            yield close()

    return run


def token_files(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> files as rows (``STORE``), not yet written; ``start`` in ``with_starts``.

    Files are in ascending doc_id order, null first; rows that share a doc_id come in the order of a hash of their
    texts, equal rows in any. Null text is empty, so a document has one token at least, ``end_id``. Other columns are
    ignored. A table without rows has no files.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "tie", "row"]  # the row splits a doc_id that very many rows share
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").transform(map_batches, _encode(path, end_id), STORE)


def with_starts(files: DataFrame) -> DataFrame:
    """Written ``files`` with ``start``: the tokens before each file in the whole corpus. One row for each range of the sort is summed and broadcast."""
    ranges = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return files.join(F.broadcast(ranges.select("part", F.coalesce(before, F.lit(0)).alias("earlier"))), "part").withColumn("start", F.col("earlier") + F.col("before")).drop("earlier")


def _documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for first, data in zip(part.column("start").to_pylist(), part.column("data"), strict=True):
            file = TokenFile(data.as_buffer())
            ids = file.codes.all().astype("<u4")
            ends = np.cumsum(file.lengths)
            begins = ends - file.lengths
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids, pa.int64()), pa.array(first + begins), pa.array(file.lengths), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(files: DataFrame) -> DataFrame:
    """Per document of ``with_starts`` files: doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit identifiers)."""
    return files.select("start", "data").transform(map_batches, _documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _tokens(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for first, data, wanted in zip(part.column("start").to_pylist(), part.column("data"), part.column("positions").to_pylist(), strict=True):
            codes = TokenFile(data.as_buffer()).codes
            yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([codes[p - first] for p in wanted], pa.int64())], ["position", "token_id"])


def tokens_at(files: DataFrame, positions: DataFrame) -> DataFrame:
    """``positions`` (position: global, from 0) -> (position, token_id), each once, read by random access.

    Positions out of range, null ones and repeats give no row. A file is joined through the cells of ``FILE_TOKENS``
    positions that it covers; the positions of a file are distinct, so they are bounded by its tokens.
    """
    cells = files.where("n_tokens > 0").select("part", "serial", "start", "n_tokens", F.explode(F.sequence(F.expr(f"start div {FILE_TOKENS}"), F.expr(f"(start + n_tokens - 1) div {FILE_TOKENS}"))).alias("cell"))
    wanted = positions.where("position is not null").select("position").distinct().withColumn("cell", F.expr(f"position div {FILE_TOKENS}"))
    found = wanted.join(cells, "cell").where("position >= start and position < start + n_tokens").groupBy("part", "serial").agg(F.collect_list("position").alias("positions"))
    return files.select("part", "serial", "start", "data").join(found, ["part", "serial"]).select("start", "data", "positions").transform(map_batches, _tokens, "position long, token_id long")


def op11_token_store(spark, sf_dir: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = materialize(token_files(docs, public_tokenizers.path("word_bpe_49k.json")), "tokens")
    return read_documents(with_starts(files))
