"""N-gram Jaccard join by filtering under multiple global token orders.

A token is the hash of five successive words. Pairs at Jaccard ``t`` or more must share a token within the first
``n - ceil(t * n) + 1`` of each set's tokens, under *any* order that all sets agree on. Every order used here
starts with the rarest tokens (the class of the document frequency) and differs in how it ranks tokens of one
class, so a pair must meet in several prefixes at once before it is verified.

1. ``token_sets``: tasks hash batches of whole texts and deal each batch's distinct tokens, with the number of its
   documents that have them, out by cells of the hash space. Cells add these numbers up and send back which tokens
   occur in two documents or more. So a token counts once a batch however common it is, and which document has it
   never leaves the batch. Tokens that no other document has only count: they stand first in every order. A document
   whose prefix they fill has no partner. Everything moves as packed blocks of a bounded size.
2. Documents with equal sets become one class, so copies are never paired with one another.
3. Classes that share a prefix token are first linked to one hub per token (a number of pairs linear in the
   postings); verified links give components. Then only pairs from different components that pass the size,
   position and prefix filters are verified, so groups of near copies don't expand into all pairs. Postings of these
   pairs meet by token and band of sizes, and one of the two must stand early enough in the smaller set to leave
   room for the overlap.
4. Pairs carry the prefixes of the other orders first; only where these meet as well are whole token sets joined.

Hashes have 48 bits in the join and 64 in the set sizes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import U64, Hasher, by_filter, chunks, key_filter, map_batches, materialize, mix, shingles, texts_of
from .components import components

#: Tokens that a cell of the hash space holds on average, whatever the size of the input.
CELL_TOKENS = 1_000_000
#: Cells at least (a token's first eight bits are its cell's then), and documents of a batch at most.
CELLS, BATCH_DOCS = 256, 2048
#: Seeds of the orders within a class of frequencies.
ORDERS = (0x51ED270B, 0x2545F491, 0x9E6C63D0)
BLOCK = "batch long, cell int, runs binary, low binary, high binary, layout binary"
FIELDS = ["batch", "cell", "runs", "low", "high", "layout"]
SETS = "doc_id long, n_tokens long, key1 long, key2 long, unique long, tokens array<long>, first array<long>, second array<long>, third array<long>"
#: Mark of a further document with the same token, in a batch's list of documents, which has 12 bits for each.
AGAIN = 0x800


def _packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary column: row ``k`` has the bytes of ``values[edges[k]:edges[k + 1]]``."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column, and each row's range of them."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data.view(kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


def _twelve(values: np.ndarray) -> bytes:
    """Numbers of 12 bits, two in three bytes."""
    a, b = np.append(values, np.zeros(len(values) % 2, values.dtype)).astype(np.uint16).reshape(-1, 2).T
    return np.stack([a & 255, a >> 8 | (b & 15) << 4, b >> 4], axis=1).astype(np.uint8).tobytes()


def _from_twelve(data: bytes, n: int) -> np.ndarray:
    x, y, z = np.frombuffer(data, np.uint8).reshape(-1, 3).T.astype(np.uint16)
    return np.stack([x | (y & 15) << 8, y >> 4 | z << 4], axis=1).ravel()[:n]


def _block(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), FIELDS)


def _deal(cells: int, size: int):
    """Texts -> blocks of distinct tokens by cell, and for each batch a head (cell -1): ids, set sizes, the documents
    of each token in ascending order of tokens, and the cells with their numbers of tokens."""
    shift = U64(48 - (cells.bit_length() - 1))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, batch = Hasher(), TaskContext.get().partitionId() << 24
        for part in parts:
            ids = np.array(part.column("doc_id").fill_null(0))
            data, offsets = texts_of(part.column("text"))
            for i, j in chunks(offsets, rows=BATCH_DOCS):
                sets = shingles(hasher, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                sizes = np.array([len(s) for s in sets], np.int64)
                both = np.sort((np.concatenate(sets) >> U64(16)) << U64(11) | np.repeat(np.arange(j - i, dtype=np.uint64), sizes))
                token, doc = both >> U64(11), (both & U64(BATCH_DOCS - 1)).astype(np.uint16)
                fresh = np.r_[True, token[1:] != token[:-1]][: len(token)]
                doc[~fresh] |= AGAIN
                at = np.flatnonzero(fresh)
                token, runs = token[at], np.diff(np.r_[at, len(doc)]).astype(np.uint16)
                cell = (token >> shift).astype(np.int32)
                edges = np.flatnonzero(np.r_[np.r_[True, cell[1:] != cell[:-1]][: len(cell)], True])
                own = cell[edges[:-1]]
                layout = np.stack([own, np.diff(edges)]).astype(np.int32)
                yield _block(*(pa.array([x], t) for x, t in ((batch, pa.int64()), (-1, pa.int32()), (_twelve(doc), pa.binary()), (ids[i:j].tobytes(), pa.binary()), (sizes.tobytes(), pa.binary()), (layout.tobytes(), pa.binary()))))
                if len(own):
                    yield _block(pa.array(np.full(len(own), batch)), pa.array(own), _packed(runs, edges), _packed(token.astype(np.uint32), edges), _packed((token >> U64(32)).astype(np.uint8), edges), _packed(runs[:0], np.zeros(len(edges), np.int64)))
                batch += 1

    return run


def _runs(parts: Iterator[pa.RecordBatch], key: str) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the rows of equal key together; rows come sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for part in parts:
        value = np.array(part.column(key))
        edge = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.zeros(0, np.int64)
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(value)], strict=False):
            if held and value[a] != last:
                yield held
                held = []
            last = value[a]
            held.append(part.slice(a, b - a))
    if held:
        yield held


def _tokens(low: np.ndarray, high: np.ndarray, cell: np.ndarray, cells: int) -> np.ndarray:
    """Tokens from their low 32 bits, the next eight, and the cell, which is their first bits."""
    shift = U64(48 - (cells.bit_length() - 1))
    return low.astype(np.uint64) | high.astype(np.uint64) << U64(32) | cell.astype(np.uint64) << shift >> U64(40) << U64(40)


def _count(cells: int):
    """A cell's blocks -> of each block its tokens' classes (0: no other document has it), and the tokens of the others."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slices in _runs(parts, "cell"):
            if slices[0].column("cell")[0].as_py() < 0:
                yield from slices
                continue
            whole = pa.Table.from_batches(slices).combine_chunks().to_batches()[0]
            low, edge = _flat(whole.column("low"), np.uint32)
            high, runs = _flat(whole.column("high"), np.uint8)[0], _flat(whole.column("runs"), np.uint16)[0]
            inside = low.astype(np.uint64) | high.astype(np.uint64) << U64(32)
            order = np.argsort(inside)
            inside = inside[order]
            head = np.flatnonzero(np.r_[True, inside[1:] != inside[:-1]])
            total = np.add.reduceat(runs[order].astype(np.int64), head)
            level = np.minimum(2 * np.log2(total), 254).astype(np.uint8)
            level[total > 1] = np.maximum(level[total > 1], 1)
            back = np.empty(len(order), np.uint8)
            back[order] = np.repeat(level, np.diff(np.r_[head, len(order)]))
            del inside, order
            shared = np.r_[0, np.cumsum(back > 0)]
            rows = np.flatnonzero(shared[edge[1:]] > shared[edge[:-1]])
            if not len(rows):
                continue
            sizes = np.diff(edge)
            keep = np.repeat(np.isin(np.arange(len(sizes)), rows), sizes)
            hit = back > 0
            own = np.r_[0, np.cumsum((shared[edge[1:]] - shared[edge[:-1]])[rows])]
            yield _block(whole.column("batch").take(pa.array(rows)), whole.column("cell").take(pa.array(rows)), _packed(back[keep], np.r_[0, np.cumsum(sizes[rows])]), _packed(low[hit], own), _packed(high[hit], own), _packed(back[:0], np.zeros(len(own), np.int64)))

    return run


def _prefixes(cells: int, percent: int):
    """A batch's blocks -> its documents, with tokens and prefixes where these aren't filled by unique tokens."""
    wide = pa.list_(pa.int64())
    types = [pa.int64()] * 5 + [wide] * 4
    names = ["doc_id", "n_tokens", "key1", "key2", "unique", "tokens", "first", "second", "third"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slices in _runs(parts, "batch"):
            ids, size, layout = (np.frombuffer(slices[0].column(c)[0].as_py(), t) for c, t in (("low", np.int64), ("high", np.int64), ("layout", np.int32)))
            entry = _from_twelve(slices[0].column("runs")[0].as_py(), int(size.sum()))
            of, n = layout.reshape(2, -1)
            begin = np.cumsum(n) - n
            level, token = np.zeros(int(n.sum()), np.uint8), np.zeros(int(n.sum()), np.uint64)
            for k, part in enumerate(slices):
                part = part.slice(1) if k == 0 else part
                if len(part):
                    cell = np.array(part.column("cell"))
                    own, edge = _flat(part.column("runs"), np.uint8)
                    at = np.arange(len(own)) + np.repeat(begin[np.searchsorted(of, cell)] - edge[:-1], np.diff(edge))
                    level[at] = own
                    low, edge = _flat(part.column("low"), np.uint32)
                    token[at[own > 0]] = _tokens(low, _flat(part.column("high"), np.uint8)[0], np.repeat(cell, np.diff(edge)), cells)
            place = np.cumsum(entry < AGAIN) - 1
            hit = level[place] > 0 if len(place) else np.zeros(0, bool)
            doc, place = (entry[hit] & (BATCH_DOCS - 1)).astype(np.int64), place[hit]
            token, level = token[place], level[place]
            shared = np.bincount(doc, minlength=len(ids))
            prefix = size - (percent * size + 99) // 100 + 1
            open_ = (size > 0) & (prefix > size - shared)
            keep = open_[doc] if len(doc) else np.zeros(0, bool)
            doc, token, level = doc[keep], token[keep], level[keep]
            ranked = []
            for seed in ORDERS:
                rank = np.lexsort((mix(token ^ U64(seed)), level, doc))
                ranked.append(token[rank].astype(np.int64))
            order = np.lexsort((token, doc))
            doc, token = doc[order], token[order].astype(np.int64)
            edge = np.searchsorted(doc, np.arange(len(ids) + 1))
            out = []
            for k in range(len(ids)):
                if open_[k]:
                    a, b = int(edge[k]), int(edge[k + 1])
                    own, unique = token[a:b], int(size[k] - shared[k])
                    key1, key2 = int(ids[k]), -1  # a document with a token of its own equals no other
                    if not unique:
                        key1, key2 = (int(mix(own.view(np.uint64) + U64(s)).sum().astype(np.int64)) for s in (1, 2))
                    out.append((int(ids[k]), int(size[k]), key1, key2, unique, own, *(r[a : a + int(prefix[k]) - unique] for r in ranked)))
                else:
                    out.append((int(ids[k]), int(size[k]), 0, 0, 0, None, None, None, None))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return run


def token_sets(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """doc_id, n_tokens, and for documents that may have a partner their shared tokens and prefixes."""
    texts = docs.select("doc_id", "text").where("doc_id is not null")
    amount = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = max(CELLS, 1 << (amount // 6 // CELL_TOKENS).bit_length())
    dealt = texts.transform(map_batches, _deal(cells, size), BLOCK)
    counted = dealt.repartition(F.when(F.col("cell") < 0, -1 - F.col("batch")).otherwise(F.col("cell"))).sortWithinPartitions("cell").transform(map_batches, _count(cells), BLOCK)
    return counted.repartition("batch").sortWithinPartitions("batch", "cell").transform(map_batches, _prefixes(cells, percent), SETS)


def _similar_sizes(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), which share a token of the first order's prefixes, that do so in all orders and have the similarity."""
    pairs = materialize(pairs, "pairs")
    in_pairs = lambda pairs: by_filter(sets, key_filter(pairs.select(F.explode(F.array("a", "b")).alias("node")), "node"), "node")
    side = lambda s, *more: own.select(F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in more))
    own = in_pairs(pairs)
    met = pairs.join(side("a", "n_tokens", "second", "third"), "a").join(side("b", "n_tokens", "second", "third"), "b")
    met = met.where(_similar_sizes("n_tokens_a", "n_tokens_b", percent) & F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b"))
    met = materialize(met.select("a", "b", (F.col("n_tokens_a") + F.col("n_tokens_b")).alias("both")), "met")
    own = in_pairs(met)
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    found = met.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b").withColumn("shared", shared)
    return found.where(F.col("shared") * 100 >= (F.col("both") - F.col("shared")) * percent).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _near_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components whose postings (token, node, n_tokens, rest, component) meet.

    ``rest`` is how many of a set's tokens stand at the posting or behind it; the overlap that a pair needs must fit
    both. The smaller set of a pair must have room for the overlap with one of its own size at least, and its partner
    lies in its band of sizes or the next one."""
    width = max(math.log(100 / percent) * 1.0001, 0.01)
    placed = postings.withColumn("band", F.floor(F.log(F.col("n_tokens").cast("double")) / width))
    small, large = (placed.select("token", F.col("band").alias("band"), *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n_tokens", "rest", "component"))) for s in "sl")
    small = small.where(F.col("rest_s") * (100 + percent) >= 2 * percent * F.col("n_tokens_s")).withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    need = (F.col("n_tokens_s") + F.col("n_tokens_l")) * percent
    ordered = (F.col("n_tokens_s") < F.col("n_tokens_l")) | ((F.col("n_tokens_s") == F.col("n_tokens_l")) & (F.col("node_s") < F.col("node_l")))
    met = small.join(large, ["token", "band"]).where(ordered & (F.col("component_s") != F.col("component_l")) & _similar_sizes("n_tokens_s", "n_tokens_l", percent) & (F.least("rest_s", "rest_l") * (100 + percent) >= need))
    return met.select(F.least("node_s", "node_l").alias("a"), F.greatest("node_s", "node_l").alias("b")).distinct()


def jaccard_components(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> doc_id, n_tokens, component_id, one row per input row.

    Two documents link when 100 * |A ∩ B| >= percent * |A ∪ B| for their sets of ``size``-word shingles;
    component_id is the smallest doc_id reachable. Null and empty texts, and texts of white space, have no
    tokens and link with nothing; equal texts link; rows that repeat a doc_id are one node, each keeps its own
    n_tokens; rows without doc_id aren't returned. Other columns are ignored.
    """
    sets = materialize(token_sets(docs, percent, size), "sets")
    found = sets.where("tokens is not null")
    # Written, so that the aggregate's dealing isn't reused by the join below and a large class can be split there.
    classes = materialize(found.groupBy("key1", "key2", "n_tokens").agg(F.min("doc_id").alias("node")), "classes")
    members = found.select("key1", "key2", "n_tokens", "doc_id").join(classes, ["key1", "key2", "n_tokens"]).select("doc_id", "node").distinct()
    nodes = materialize(found.join(classes.select("key1", "key2", "n_tokens", F.col("node").alias("doc_id")), ["key1", "key2", "n_tokens", "doc_id"], "left_semi").dropDuplicates(["key1", "key2", "n_tokens", "doc_id"]).withColumnRenamed("doc_id", "node"), "nodes")

    postings = nodes.select("node", "n_tokens", "unique", F.posexplode("first").alias("at", "token"))
    postings = postings.select("token", "node", "n_tokens", (F.col("n_tokens") - F.col("unique") - F.col("at")).alias("rest"))
    hubs = postings.groupBy("token").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    star = postings.join(hubs, "token").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(_verify(star, nodes, percent), "star")
    known = materialize(components(links), "known")

    placed = postings.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = placed.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("token")
    rest = materialize(placed.join(open_, "token", "left_semi"), "open")
    pairs = _near_pairs(rest, percent).join(star, ["a", "b"], "left_anti")
    more = materialize(_verify(pairs, nodes, percent), "more")
    if more.isEmpty():
        final = known
    else:
        final = materialize(components(known.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more)), "final")

    placed = members.join(final, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component"))
    return sets.select("doc_id", "n_tokens").join(placed, "doc_id", "left").select("doc_id", "n_tokens", F.coalesce("component", "doc_id").alias("component_id"))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    found = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumnRenamed("n_tokens", "n_shingles")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 75 * (x.n + y.n - k)),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.v, r.m FROM r JOIN e ON e.u = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.m AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(m) AS m FROM r GROUP BY doc_id) c USING (doc_id)
"""
