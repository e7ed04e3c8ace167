"""Benchmark decontamination by greedy string tiling.

Words (letters and digits, lower case) are tokens. Documents and benchmark items that share a seed, a run of
``least`` tokens, are joined on it. For each such pair the longest matches between unmarked tokens are marked,
again and again, found by Karp-Rabin hashes of windows, until none of ``least`` tokens is left. The tiles don't
overlap on either side and may come in any order, so a passage whose sentences were moved is covered all the same.
A document is contaminated if tiles cover a share of an item.

Only the parts of a document whose windows may be seeds travel to the join. Which may is told by a bit table of the
benchmark's seeds, of ``TABLE_BITS`` bits at most. Tiles over a share of an item's n words need share * n / ``least``
of its seeds at least, so each item's most common seeds, one less than that, join nothing: a phrase that many texts
share doesn't pair them all. Before a pair is tiled, the words of the item within shared seeds are counted: they
bound what tiles may cover. Equal texts are tiled once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import LOWER, U64, Hasher, chunks, classes, map_batches, materialize, mix, texts_of, words

TOKEN = classes(members=bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
#: Bits of the table of seeds, as a power of two, at least and at most; 256 for each seed in between, so few others pass.
TABLE_BITS = (24, 26)
_FACTOR = 0x9E3779B97F4A7C15


def _tokens(hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    start, end, edge = words(data, offsets, TOKEN)
    return hasher.ranges(hasher.prefix(data), start, end), edge


def _windows(token: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` successive tokens."""
    if len(token) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(token) - size + 1, np.uint64)
    for k in range(size):
        out = out * U64(_FACTOR) + token[k : len(token) - size + 1 + k]
    return mix(out)


class _Side:
    """Tokens of which some are marked, and Karp-Rabin hashes (modulo 2**64) of their windows of any length."""

    BASE, INVERSE = _FACTOR, pow(_FACTOR, -1, 2**64)

    def __init__(self, token: np.ndarray):
        self.token, n = token, len(token)
        up, down = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, b, np.uint64)]) for b in (self.BASE, self.INVERSE))
        self.sums = np.r_[np.uint64(0), np.cumsum(mix(token.view(np.uint64)) * up[:n], dtype=np.uint64)]
        self.down, self.used = down, np.zeros(n, bool)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of the windows of ``length`` unmarked tokens."""
        free = np.r_[0, np.cumsum(self.used)]
        at = np.flatnonzero(free[length:] == free[:-length])
        return at, (self.sums[at + length] - self.sums[at]) * self.down[at]


def tiles(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(position in text, position in item, length) of the tiles of at least ``least`` tokens, longest first.

    Of matches of one length, those first in the text, then in the item, are marked first. The greatest length that
    windows of unmarked tokens share is found by halving, and all its tiles are marked in one pass; as tiles don't
    overlap, there are few such lengths, and a pass is about linear even where all tokens are equal.
    """
    a_side, b_side, out = _Side(np.asarray(text, np.int64)), _Side(np.asarray(item, np.int64)), []
    high = min(len(text), len(item))

    def shared(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        (a, x), (b, y) = a_side.windows(length), b_side.windows(length)
        order = np.argsort(y, kind="stable")
        y = y[order]
        slot = np.searchsorted(y, x)
        hit = np.flatnonzero(y[np.minimum(slot, len(y) - 1)] == x) if len(y) else np.zeros(0, np.int64)
        return a[hit], slot[hit], b[order], y

    while high >= least:
        low, found = least, shared(least)
        if not len(found[0]):
            break
        while low < high:
            middle = (low + high + 1) // 2
            if len((now := shared(middle))[0]):
                low, found = middle, now
            else:
                high = middle - 1
        at, slot, where, hashes = found
        behind, next_, where = 0, {}, where.tolist()
        for a, first in zip(at.tolist(), slot.tolist(), strict=True):
            if a < behind:
                continue
            k = next_.get(first, first)  # earlier windows of this hash overlap tiles
            while k < len(where) and hashes[k] == hashes[first] and b_side.used[[where[k], where[k] + low - 1]].any():
                k += 1
            next_[first] = k
            if k < len(where) and hashes[k] == hashes[first] and (a_side.token[a : a + low] == b_side.token[where[k] : where[k] + low]).all():
                a_side.used[a : a + low] = b_side.used[where[k] : where[k] + low] = True
                behind = a + low
                out.append((a, where[k], low))
        high = low - 1
    return out


def coverable(text: np.ndarray, item: np.ndarray, least: int) -> int:
    """Tokens of ``item`` within windows of ``least`` that ``text`` has: tiles can't cover more."""
    if min(len(text), len(item)) < least:
        return 0
    hit = np.isin(_windows(item.view(np.uint64), least), _windows(text.view(np.uint64), least))
    ends = np.zeros(len(item) + 1, np.int64)
    np.add.at(ends, np.flatnonzero(hit), 1)
    np.add.at(ends, np.flatnonzero(hit) + least, -1)
    return int((np.cumsum(ends[:-1]) > 0).sum())


def _items(least: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for part in parts:
            token, edge = _tokens(hasher, *texts_of(part.column("text")))
            own = [token[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            seeds, counts = zip(*(np.unique(_windows(x, least), return_counts=True) for x in own), strict=True) if own else ((), ())
            wide = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("item_id"), part.column("code"), pa.array([x.view(np.int64) for x in own], wide), pa.array([x.view(np.int64) for x in seeds], wide), pa.array(list(counts), wide)], ["item_id", "code", "item", "seeds", "counts"])

    return run


def _hits(table: np.ndarray, bits: int, least: int):
    """Texts -> key, the parts that may match (tokens; a negative number between parts), and their windows."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for part in parts:
            data, offsets = texts_of(part.column("text"))
            keys, out = part.column("key").to_pylist(), []
            for i, j in chunks(offsets):
                token, edge = _tokens(hasher, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                window = _windows(token, least)
                slot = (window >> U64(64 - bits)).astype(np.int64)
                hit = np.flatnonzero((table[slot >> 6] >> (slot & 63).astype(np.uint64)) & U64(1))
                row = np.searchsorted(edge, hit, "right") - 1
                inside = hit + least <= edge[row + 1]
                hit, row = hit[inside], row[inside]
                if not len(row):
                    continue
                cut = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(row)], strict=True):
                    own, pieces, breaks = hit[a:b], [], 0
                    gap = np.flatnonzero(np.diff(own) > least) + 1
                    for run_ in np.split(own, gap):
                        breaks += 1
                        pieces += [token[run_[0] : run_[-1] + least].view(np.int64) >> 1 & ((1 << 62) - 1), [-breaks]]
                    out.append((keys[i + int(row[a])], np.concatenate(pieces), np.unique(window[own]).view(np.int64)))
            if out:
                wide = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), (pa.binary(), wide, wide), strict=True)], ["key", "parts", "seeds"])

    return run


def _tiled(least: int, share: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep, out = [], []
            for k, (text, item) in enumerate(zip(part.column("parts"), part.column("item"), strict=True)):
                text, item = (x.values.to_numpy(zero_copy_only=False) for x in (text, item))
                item = item >> 1 & ((1 << 62) - 1)
                if coverable(text, item, least) >= share * len(item):
                    found = tiles(text, item, least)
                    keep.append(k)
                    out.append((sum(n for *_, n in found), len(found)))
            names = ["key", "item_id", "n_item"]
            covered, n = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(keep, pa.int64())) for c in names), pa.array(covered, pa.int64()), pa.array(n, pa.int64())], [*names, "covered", "n_tiles"])

    return run


def text_key() -> Column:
    """16 bytes that stand for a row's text; null has none."""
    return F.unhex(F.md5("text"))


def _table(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """A bit table of the distinct ``seeds``, gathered by words of 64 bits, and its size as a power of two."""
    least, most = TABLE_BITS
    bits = min(most, max(least, (256 * seeds.count()).bit_length()))
    slot = F.shiftrightunsigned("seed", 64 - bits)
    rows = seeds.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned(seed, {64 - bits}) & 63))")).alias("bits")).toArrow()
    table = np.zeros(1 << bits - 6, np.uint64)
    table[np.array(rows.column("word"))] = np.array(rows.column("bits")).astype(np.int64).view(np.uint64)
    return table, bits


def tiled_pairs(docs: DataFrame, benchmark: DataFrame, least: int = 5, share: float = 0.6) -> DataFrame:
    """(key, item_id, n_item, covered, n_tiles) for texts and items whose tiles may cover ``share`` of the item; key is ``text_key``.

    Items are told apart by identifier and text, so each text of an item_id, or of none, is tested."""
    code = F.md5(F.concat_ws(":", "item_id", "text")).alias("code")
    items = materialize(benchmark.select("item_id", code, "text").transform(map_batches, _items(least), "item_id long, code string, item array<long>, seeds array<long>, counts array<long>").dropDuplicates(["code"]), "items")
    table, bits = _table(items.select(F.explode("seeds").alias("seed")).distinct())
    hits = materialize(docs.where("text is not null").select(text_key().alias("key"), "text").transform(map_batches, _hits(table, bits, least), "key binary, parts array<long>, seeds array<long>").dropDuplicates(["key"]), "hits")
    found = hits.select("key", F.explode("seeds").alias("seed"))
    common = found.groupBy("seed").agg(F.count("*").alias("df"))
    own = items.select("code", F.size("item").alias("n"), F.explode(F.arrays_zip("seeds", "counts")).alias("x")).select("code", "n", F.col("x.seeds").alias("seed"), F.col("x.counts").alias("times")).join(common, "seed")
    ahead = F.sum("times").over(Window.partitionBy("code").orderBy(F.desc("df"), "seed"))
    joining = own.withColumn("ahead", ahead).where(F.col("ahead") >= F.ceil(F.col("n") * (share / least) - 1e-9)).select("code", "seed")
    pairs = found.join(joining, "seed").select("key", "code").distinct()
    both = pairs.join(hits.select("key", "parts"), "key").join(items.select("item_id", "code", "item", F.size("item").cast("long").alias("n_item")), "code")
    return both.select("key", "item_id", "n_item", "parts", "item").transform(map_batches, _tiled(least, share - 1e-9), "key binary, item_id long, n_item long, covered long, n_tiles long")


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = 5, share: float = 0.6) -> DataFrame:
    """key, coverage, item_id, n_items, n_tiles of the contaminated documents: tiles cover ``share`` of an item's words.

    The item reported is the one covered best, the smallest item_id on ties; n_items counts all that reach the
    share. Items and documents under ``least`` words, null and empty ones match nothing. Equal texts have one
    key; benchmark rows that repeat count once; other texts of an
    item_id, or of none, are items of their own. Other columns are ignored.
    """
    good = tiled_pairs(docs, benchmark, least, share).withColumn("coverage", F.col("covered") / F.col("n_item")).where(F.col("coverage") >= share)
    best = F.max_by(F.struct("item_id", "n_tiles"), F.struct("coverage", -F.col("item_id")))
    return good.groupBy("key").agg(F.max("coverage").alias("coverage"), best.alias("best"), F.count("*").alias("n_items")).select("key", "coverage", "best.item_id", "best.n_tiles", "n_items")


def op2_string_tiling_decontamination(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, contaminated, coverage, item_id (best covered), n_items, n_tiles."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = contamination(docs, benchmark)
    return docs.select("doc_id", text_key().alias("key")).join(found, "key", "left").select(
        "doc_id", F.col("coverage").isNotNull().alias("contaminated"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"), "item_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_tiles", F.lit(0)).alias("n_tiles")
    )
