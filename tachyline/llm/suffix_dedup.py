"""Exact substring dedup with suffix arrays over shards that hold every pair of equal windows together.

A window of ``length`` bytes contains the same anchor wherever it occurs: the leftmost smallest hash among its
strings of a quarter of that length. Each anchor owns the run of window starts that choose it. Anchors whose string occurs
once can't own a repeated window and are dropped; the contexts of the others (the bytes of all windows that they
own) are dealt out by the anchor's hash, so equal windows meet in one shard. In a shard, equal contexts are
merged, the suffix array of the rest is built by induced sorting, and permuted common prefixes between successive
window starts tell which windows occur more than once. Their bytes are then cut from the documents.

Shards are cut between anchors at ``SHARD_BYTES`` of distinct contexts at least; contexts that are equal count once, so a
passage in any number of documents is one context but for the two at its ends. Those carry each document's own bytes,
so an anchor there may have more than ``WIDE_BYTES`` of distinct contexts. Such a wide anchor has no shard: its
windows are dealt one by one, by a digest of all their bytes, and those whose digest occurs more than once are repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import U64, Hasher, by_filter, chunks, key_filter, map_batches, materialize, row_key, texts_of
from .induced_sort import common_prefixes, suffix_array

SHARD_BYTES = 2 << 20
#: An anchor with more bytes of distinct contexts is wide.
WIDE_BYTES = 1 << 19
#: An anchor with more than one in so many of all occurrences is hot; its occurrences aren't dealt out by it.
HOT_SHARE = 1000
#: Bytes of a ``row_key``.
KEY = 16


def _smallest(value: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` successive values."""
    n = len(value)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = value
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, start, count, owners, hash, context): the windows from ``start`` on, ``count`` of them, choose the anchor
    with ``hash``, which stands at ``owners`` places; ``context`` is the hash of their bytes."""
    n, anchor, none = len(data), length // 4, np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none, none
    prefix = hasher.prefix(data)
    at = np.arange(n - anchor + 1)
    hashes = hasher.ranges(prefix, at, at + anchor)
    chosen = _smallest((hashes >> U64(32) << U64(32)) | at.astype(np.uint64), length - anchor + 1) & U64(0xFFFFFFFF)
    inside = np.zeros(len(chosen), bool)
    sizes = np.diff(offsets)
    for a, k in zip(offsets[:-1][sizes >= length].tolist(), sizes[sizes >= length].tolist(), strict=True):
        inside[a : a + k - length + 1] = True
    start = np.flatnonzero(inside)
    if not len(start):
        return none, none, none, none, none, none
    at = chosen[start].astype(np.int64)
    owner = hashes[at]
    edge = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)])
    # Where a string repeats itself closely, the same anchor is chosen on and on: runs end after as many windows as one can own.
    since = np.arange(len(start)) - np.repeat(edge, np.diff(np.r_[edge, len(start)]))
    edge = np.flatnonzero(since % (length - anchor + 1) == 0)
    count = np.diff(np.r_[edge, len(start)])
    owners = np.add.reduceat(np.r_[True, at[1:] != at[:-1]].astype(np.int32), edge)
    owners += ~np.r_[True, at[1:] != at[:-1]][edge]
    first = start[edge]
    row = np.searchsorted(offsets, first, "right") - 1
    return row, first - offsets[row], count, owners, owner[edge].view(np.int64), hasher.ranges(prefix, first, first + count - 1 + length).view(np.int64)


def _anchor_rows(length: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for part in parts:
            keys = part.column("key")
            data, offsets = texts_of(part.column("text"))
            for i, j in chunks(offsets):
                row, start, count, owners, found, context = anchors(hasher, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length)
                if len(row):
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(row + i)), pa.array(found), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(owners.astype(np.int32)), pa.array(context)], ["key", "anchor", "start", "count", "owners", "context"])

    return run


def _contexts(length: int):
    """Texts with their repeated anchors -> contexts; equal ones that a task meets soon after one another share a row."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[tuple[int, int, bytes], tuple[list[bytes], list[int]]] = {}
        size = 0
        for part in parts:
            for key, text, own in zip(part.column("key").to_pylist(), part.column("text"), part.column("own").to_pylist(), strict=True):
                text = text.as_buffer().to_pybytes()
                for x in own:
                    context = text[x["start"] : x["start"] + x["count"] - 1 + length]
                    keys, starts = rows.setdefault((x["anchor"], x["count"], context), ([], []))
                    size += len(context) if not keys else KEY + 4
                    keys.append(key)
                    starts.append(x["start"])
                if size > SHARD_BYTES:
                    yield emit(rows)
                    rows, size = {}, 0
        if rows:
            yield emit(rows)

    def emit(rows: dict) -> pa.RecordBatch:
        anchor, count, context = zip(*rows, strict=True)
        keys, starts = zip(*rows.values(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(count, pa.int32()), pa.array(context, pa.binary()), pa.array([b"".join(k) for k in keys], pa.binary()), pa.array([np.array(s, np.int32).tobytes() for s in starts], pa.binary())], ["anchor", "count", "context", "keys", "starts"])

    return run


def _windows(length: int):
    """Texts with their runs of windows -> (high, low, key, start): 128 bits of a digest of each window's bytes."""

    def emit(digests: list[bytes], keys: list[bytes], starts: list[np.ndarray]) -> pa.RecordBatch:
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(keys, pa.binary()), pa.array(np.concatenate(starts))], ["high", "low", "key", "start"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, keys, starts = [], [], []
        for part in parts:
            for key, text, own in zip(part.column("key").to_pylist(), part.column("text"), part.column("own").to_pylist(), strict=True):
                text = memoryview(text.as_buffer())
                for x in own:
                    at = range(x["start"], x["start"] + x["count"])
                    digests += [hashlib.blake2b(text[a : a + length], digest_size=16).digest() for a in at]
                    keys += [key] * len(at)
                    starts.append(np.array(at, np.int64))
                    if len(digests) > 1 << 16:
                        yield emit(digests, keys, starts)
                        digests, keys, starts = [], [], []
        if digests:
            yield emit(digests, keys, starts)

    return run


def repeated(contexts: list[tuple[bytes, int]], length: int) -> list[np.ndarray]:
    """For each (bytes, windows): which of its windows occur elsewhere among all windows given."""
    size = np.array([len(c) for c, _ in contexts])
    begin = np.r_[0, np.cumsum(size + 1)[:-1]]
    text = np.frombuffer(b"\xff".join(c for c, _ in contexts) + b"\xff\xff", np.uint8) + np.uint8(2)  # 0xff becomes 1
    text[-1] = 0
    counted = np.zeros(len(text), bool)
    for a, (_, n) in zip(begin.tolist(), contexts, strict=True):
        counted[a : a + n] = True
    order = suffix_array(text)
    order = order[counted[order]]
    shared = common_prefixes(text, order)
    twice = np.zeros(len(text), bool)
    again = shared[order[1:]] >= length
    twice[order[1:][again]] = True
    twice[order[:-1][again]] = True
    return [twice[a : a + n] for a, (_, n) in zip(begin.tolist(), contexts, strict=True)]


def _shards(length: int):
    """Contexts sorted by anchor -> (key, start, end): ranges of bytes that repeated windows cover."""

    def solve(group: dict) -> Iterator[pa.RecordBatch]:
        if not group:
            return
        items = list(group.items())
        found = repeated([(context, count) for (_, count, context), _ in items], length)
        out = []
        for ((_, count, _), (keys, starts)), hits in zip(items, found, strict=True):
            keys, starts = np.concatenate(keys), np.concatenate(starts).astype(np.int64)
            if len(keys) > 1:
                hits = np.ones(count, bool)
            edge = np.flatnonzero(np.diff(np.r_[False, hits, False].astype(np.int8)))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                out.append((keys, starts + a, starts + b - 1 + length))
        if out:
            keys, starts, ends = map(np.concatenate, zip(*out, strict=True))
            places = pa.py_buffer(np.arange(0, KEY * len(keys) + 1, KEY, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(keys), [None, places, pa.py_buffer(keys.tobytes())]), pa.array(starts), pa.array(ends)], ["key", "start", "end"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size, last = {}, 0, None
        for part in parts:
            columns = [part.column(k).to_pylist() for k in ("anchor", "count", "context", "keys", "starts")]
            for anchor, count, context, keys, starts in zip(*columns, strict=True):
                if anchor != last and size > SHARD_BYTES:
                    yield from solve(group)
                    group, size = {}, 0
                last = anchor
                at = group.setdefault((anchor, count, context), ([], []))
                size += len(context) if not at[0] else 0
                at[0].append(np.frombuffer(keys, f"V{KEY}"))
                at[1].append(np.frombuffer(starts, np.int32))
        yield from solve(group)

    return run


def dealt(docs: DataFrame, length: int = 400) -> tuple[DataFrame, DataFrame | None]:
    """The contexts of anchors that fit a shard (anchor, count, context, keys, starts), and the windows of wide
    anchors (high, low, key, start), if there are any."""
    texts = docs.select(row_key().alias("key"), "text").where(F.octet_length("text") >= length)
    found = materialize(texts.transform(map_batches, _anchor_rows(length), "key binary, anchor long, start int, count int, owners int, context long"), "anchors")
    counts = materialize(found.groupBy("anchor").agg(F.sum("owners").alias("n")).where("n > 1"), "counts")
    hot = F.col("n") * HOT_SHARE > found.agg(F.coalesce(F.sum("owners"), F.lit(0))).first()[0]  # fewer than HOT_SHARE anchors, so they are broadcast

    def of(chosen: DataFrame) -> DataFrame:
        return found.join(F.broadcast(chosen.where(hot)), "anchor", "left_semi").unionByName(found.join(chosen.where(~hot), "anchor", "left_semi"))

    def with_texts(rows: DataFrame, name: str) -> DataFrame:
        own = materialize(rows.dropDuplicates(["key", "start"]).groupBy("key").agg(F.collect_list(F.struct("anchor", "start", "count")).alias("own")), name)
        return by_filter(texts, key_filter(own)).join(own, "key")

    # A context has fewer than 2 * length bytes, so anchors with few of them can't be wide.
    sizes = of(counts.where(F.col("n") * 2 * length > WIDE_BYTES)).select("anchor", "count", "context").distinct().groupBy("anchor").agg(F.sum(F.col("count") - 1 + length).alias("size"))
    wide = materialize(sizes.where(F.col("size") > WIDE_BYTES).select("anchor"), "wide")
    windows = None
    narrow = counts
    if not wide.isEmpty():
        windows = with_texts(of(counts.join(wide, "anchor", "left_semi")), "wide_own").transform(map_batches, _windows(length), "high long, low long, key binary, start long")
        narrow = counts.join(wide, "anchor", "left_anti")
    return with_texts(of(narrow), "own").transform(map_batches, _contexts(length), "anchor long, count int, context binary, keys binary, starts binary"), windows


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> key, spans: by ``row_key`` of a document, the byte ranges that repeated windows cover."""
    contexts, windows = dealt(docs, length)
    spans = contexts.repartition("anchor").sortWithinPartitions("anchor").transform(map_batches, _shards(length), "key binary, start long, end long")
    if windows is not None:
        windows = materialize(windows, "windows")
        again = materialize(windows.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "again")
        hits = windows.join(again, ["high", "low"], "left_semi").select("key", "start").distinct()
        run = F.col("start") - F.row_number().over(Window.partitionBy("key").orderBy("start"))
        spans = spans.unionByName(hits.withColumn("run", run).groupBy("key", "run").agg(F.min("start").alias("start"), (F.max("start") + length).alias("end")).drop("run"))
    return spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        out = []
        for text, spans in zip(part.column("text"), part.column("spans").to_pylist(), strict=True):
            text = text.as_buffer().to_pybytes() if text.is_valid else b""
            keep, removed, runs, end = [], 0, 0, 0
            for x in sorted((s["start"], s["end"]) for s in spans or ()):
                if x[0] > end or not runs:
                    keep.append(text[end : x[0]])
                    runs += 1
                    removed += x[1] - x[0]
                    end = x[1]
                elif x[1] > end:
                    removed += x[1] - end
                    end = x[1]
            kept = b"".join(keep) + text[end:]
            out.append((len(text), removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
        columns = list(zip(*out, strict=True)) or [()] * 5
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        extra = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *extra], ["doc_id", *names])


def suffix_dedup(docs: DataFrame, length: int = 400) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, one row per input row.

    Every byte of the UTF-8 text that lies in a string of ``length`` bytes which also starts anywhere else, in
    this text or another, is removed. ``kept`` is the rest as text; where a cut splits a character, its remaining
    bytes count in ``kept_sha256`` but not in ``kept``. Null counts as empty; texts under ``length`` bytes are
    whole; repeated rows repeat each other; a null doc_id is a document like others. Other columns are ignored.
    """
    spans = materialize(repeated_spans(docs, length), "spans")
    rows, table = docs.select("doc_id", "text", row_key().alias("key")), key_filter(spans)
    cut = by_filter(rows, table).join(spans, "key", "left").select("doc_id", "text", "spans")
    whole = by_filter(rows, table, maybe=False).select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return cut.unionByName(whole).transform(map_batches, _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")


def op10_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, has_repeat (something was removed), n_bytes, n_removed, n_spans, kept_sha256."""
    found = suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", (F.col("n_removed") > 0).alias("has_repeat"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i AS pos, md5(h[2*i+1:2*i+800]) AS m FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h)//2 - 399, 0)::BIGINT)) AS i FROM d)),
r AS (SELECT doc_id, pos FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
g AS (SELECT doc_id, pos, sum(CASE WHEN prior IS NULL OR pos > prior + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run
      FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS prior FROM r)),
s AS (SELECT doc_id, run, min(pos) AS a, max(pos) + 400 AS b FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS runs, array_agg(a ORDER BY a) AS starts, array_agg(b ORDER BY a) AS ends FROM s GROUP BY doc_id)
SELECT d.doc_id, runs IS NOT NULL AS has_repeat, (len(h)//2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN runs IS NULL THEN h ELSE
    array_to_string(list_transform(range(1, runs + 2), lambda i: h[2 * (CASE WHEN i = 1 THEN 0 ELSE ends[i-1] END) + 1 : 2 * (CASE WHEN i = runs + 1 THEN len(h)//2 ELSE starts[i] END)]), '') END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
