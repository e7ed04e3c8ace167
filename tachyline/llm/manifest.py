"""Merkle manifest of a dataset: groups of ordered rows, one root, and a proof for every row.

A row is a leaf, the SHA-256 of its fields. Within a group leaves are ordered; every eight consecutive nodes become their
parent, the last run of a level may be shorter, and nothing is padded. The one node that remains of a group is its
subroot; subroots, in the order of groups, are leaves of a second tree of the same kind, whose top is the root.

Leaves are dealt out by ranges of (group, key) and packed into chunks of consecutive leaves. Once each chunk's place in its
group is known, a mountain-range stack reads it: a node that ends a run carries its parent to the next level, so
completed runs turn into node records at once, and what a chunk can't complete at either edge is left as an edge record,
some fourteen for a level. Edges are merged level by level, at most eight digests to a group of the shuffle. The merged
runs then pass their digests down, each one to the eight runs below it, so a chunk gets all siblings that lie outside of
it by two keys, however many chunks share a branch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import map_batches, materialize

FANOUT = 8
CHUNK = 4096  # leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RECORD = "grp string, total long, level int, idx long, digest binary, edge boolean"


def join_hash(digests: list[str]) -> str:
    """The node over digests in hexadecimal."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _field(value: bytes | None) -> bytes:
    return b"-" if value is None else b"%d:%b" % (len(value), value)


def leaf_digests(docs: DataFrame, tampered: Column) -> DataFrame:
    """``docs`` -> grp, id, digest, other: group key, doc_id, leaf, and the leaf with A-Z of the text in lower case where ``tampered``.

    A null field has a mark of its own, so it differs from an empty one. Other columns than ``FIELDS`` are ignored.
    """
    values = [F.col(c).cast("string").cast("binary").alias(f"f{k}") for k, c in enumerate(FIELDS)]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for grp, key, marked, *fields in zip(*(part.column(k).to_pylist() for k in range(part.num_columns)), strict=True):
                head = hashlib.sha256(b"".join(map(_field, fields[:-1])))
                leaf, other = head.copy(), head
                leaf.update(_field(fields[-1]))
                if marked:
                    other.update(_field(fields[-1] if fields[-1] is None else fields[-1].lower()))
                out.append((grp, key, leaf.digest(), other.digest() if marked else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["grp", "id", "digest", "other"])

    group = F.coalesce(F.concat(F.lit(":"), "lang"), F.lit(""))  # null comes first
    return docs.select(group.alias("grp"), F.col("doc_id").cast("long").alias("id"), F.coalesce(tampered, F.lit(False)).alias("marked"), *values).transform(map_batches, run, "grp string, id long, digest binary, other binary")


def _pack(id_type: pa.DataType, size: int):
    """Sorted leaves -> chunks of one group each. ``before`` counts the group's leaves in earlier chunks of the range."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial, group, before = TaskContext.get().partitionId(), 0, None, 0
        ids, digests, others = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal serial, before, ids, digests, others
            arrays = [pa.array([task], pa.int32()), pa.array([serial], pa.int32()), pa.array([group]), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([b"".join(digests)], pa.binary()), pa.array([others], pa.list_(pa.binary()))]
            before, serial, ids, digests, others = before + len(ids), serial + 1, [], [], []
            return pa.RecordBatch.from_arrays(arrays, ["part", "serial", "grp", "before", "n", "ids", "digests", "others"])

        for part in parts:
            for grp, key, digest, other in zip(*(part.column(c).to_pylist() for c in ("grp", "id", "digest", "other")), strict=True):
                if ids and (grp != group or len(ids) == size):
                    yield close()
                if grp != group:
                    group, before = grp, 0
                ids.append(key)
                digests.append(digest)
                others.append(other)
        if ids:
            yield close()

    return run


def level_sizes(total: int) -> list[int]:
    """Nodes of each level of a group, down to one."""
    sizes = [total]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FANOUT))
    return sizes


class MountainRange:
    """The stack of a chunk: for each level the nodes of its open run. ``push`` leaves in order, then ``close``.

    ``runs`` has the completed runs, (level, number of the run) -> digests; ``edges`` the nodes whose run isn't complete
    within the chunk, the top of a group included: (level, index, digest).
    """

    def __init__(self, total: int):
        self.sizes = level_sizes(total)
        self.open: list[list[str]] = [[] for _ in self.sizes]
        self.last = [0] * len(self.sizes)
        self.runs: dict[tuple[int, int], list[str]] = {}
        self.edges: list[tuple[int, int, str]] = []

    def push(self, index: int, digest: str) -> None:
        level = 0
        while True:
            held = self.open[level]
            held.append(digest)
            self.last[level] = index
            if index % FANOUT != FANOUT - 1 and index != self.sizes[level] - 1:
                return
            first = index - len(held) + 1
            self.open[level] = []
            if first % FANOUT or level + 1 == len(self.sizes):
                self.edges += [(level, first + k, d) for k, d in enumerate(held)]
                return
            run = index // FANOUT
            self.runs[level, run] = held
            level, index, digest = level + 1, run, join_hash(held)

    def close(self) -> None:
        for level, held in enumerate(self.open):
            self.edges += [(level, self.last[level] - len(held) + 1 + k, d) for k, d in enumerate(held)]


def _stack(first: int, total: int, digests: bytes) -> MountainRange:
    stack = MountainRange(total)
    for k in range(len(digests) // 32):
        stack.push(first + k, digests[32 * k : 32 * k + 32].hex())
    stack.close()
    return stack


def open_runs(stack: MountainRange) -> list[tuple[int, int]]:
    """(level, number) of the lowest run at each side of a chunk that it doesn't complete, or the group's top: one or two keys.

    All other runs that its leaves need lie above these or within the chunk.
    """
    runs = sorted({(level, index // FANOUT) for level, index, _ in stack.edges})
    return [r for r in runs if not any(below < r[0] and number // FANOUT ** (r[0] - below) == r[1] for below, number in runs)]


def _records(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for grp, total, first, digests in zip(*(part.column(c).to_pylist() for c in ("grp", "total", "first", "digests")), strict=True):
            stack = _stack(first, total, digests)
            rows = [(level, run * FANOUT + k, d, False) for (level, run), held in stack.runs.items() for k, d in enumerate(held) if level] + [(*e, True) for e in stack.edges]
            n = len(rows)
            yield pa.RecordBatch.from_arrays([pa.array([grp] * n), pa.array([total] * n, pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([bytes.fromhex(r[2]) for r in rows], pa.binary()), pa.array([r[3] for r in rows])], [c.split()[0] for c in RECORD.split(", ")])


def _needs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        rows = [(a, b, grp, *key) for a, b, grp, total, first, digests in zip(*(part.column(c).to_pylist() for c in ("part", "serial", "grp", "total", "first", "digests")), strict=True) for key in open_runs(_stack(first, total, digests))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64()), strict=True)], ["part", "serial", "grp", "level", "run"])


@dataclass
class Tree:
    """``chunks`` of leaves with their place; ``records``: node records of all levels but the leaves inside chunks;
    ``runs`` by level: the runs that no chunk completes; ``tops``: one row for each group."""

    chunks: DataFrame
    records: DataFrame
    runs: list[DataFrame]
    tops: DataFrame


def build(leaves: DataFrame, order: list[str | Column], chunk: int = CHUNK) -> Tree:
    """``leaves`` (grp, id, digest, other) -> ``Tree``. Within a group leaves ascend by ``order``; equal rows in any order."""
    spark = leaves.sparkSession
    leaves = materialize(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    kind, id_type = leaves.schema["id"].dataType.simpleString(), pa.string() if leaves.schema["id"].dataType.typeName() == "string" else pa.int64()
    by = ["grp", *order, "row"]  # the row splits a key that very many rows share
    packed = leaves.repartitionByRange(*by).sortWithinPartitions(*by).select("grp", "id", "digest", "other")
    packed = materialize(map_batches(packed, _pack(id_type, chunk), f"part int, serial int, grp string, before long, n long, ids array<{kind}>, digests binary, others array<binary>"), "chunks")
    counts = packed.groupBy("grp", "part").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("grp")
    places = counts.select("grp", "part", F.sum("n").over(own).alias("total"), (F.sum("n").over(own.orderBy("part")) - F.col("n")).alias("start"))
    chunks = materialize(packed.join(places, ["grp", "part"]).withColumn("first", F.col("start") + F.col("before")).drop("before", "start"), "placed")
    records = materialize(chunks.select("grp", "total", "first", "digests").transform(map_batches, _records, RECORD), "records")
    most = places.agg(F.max("total")).first()[0] or 0
    edges, runs, merged = records.where("edge").drop("edge"), [], None
    tops = []
    for level in range(len(level_sizes(most))):
        here = edges.where(F.col("level") == level)
        here = here if merged is None else here.unionByName(merged)
        size = f"(total + {FANOUT**level - 1}L) div {FANOUT**level}L"
        tops.append(here.where(f"{size} = 1").select("grp", "level", F.col("digest").alias("top")))
        run = here.where(f"{size} > 1").groupBy("grp", "total", "level", F.expr(f"idx div {FANOUT}").alias("run")).agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("nodes"))
        runs.append(materialize(run.select("grp", "total", "level", "run", F.col("nodes.digest").alias("digests")), "runs"))
        text = F.array_join(F.transform("digests", lambda d: F.lower(F.hex(d))), "")
        merged = runs[-1].select("grp", "total", (F.col("level") + 1).alias("level"), F.col("run").alias("idx"), F.unhex(F.sha2(text, 256)).alias("digest"))
    none = spark.createDataFrame([], "grp string, level int, top binary")
    return Tree(chunks, records, runs, materialize(reduce(DataFrame.unionByName, tops, none), "tops"))


def _paths(tree: Tree, above: DataFrame) -> DataFrame:
    """For each run that no chunk completes, and each top: grp, level, run, inside (digests of it and of the runs over
    it, upwards) and ``above``, what ``above`` (grp, above) says of its group."""
    none = F.array().cast("array<array<binary>>")
    ends = materialize(tree.tops.join(above, "grp").select("grp", "level", F.lit(0).cast("long").alias("run"), none.alias("inside"), "above"), "paths")
    out, over = [ends], ends
    for level in range(len(tree.runs) - 1, -1, -1):
        own = tree.runs[level].select("grp", "level", "run", "digests", F.expr(f"run div {FANOUT}").alias("up"))
        upper = over.where(F.col("level") == level + 1).select("grp", F.col("run").alias("up"), "inside", "above")
        over = materialize(own.join(upper, ["grp", "up"]).select("grp", "level", "run", F.concat(F.array("digests"), "inside").alias("inside"), "above"), "paths")
        out.append(over)
        over = over.unionByName(ends.where(F.col("level") == level))
    return reduce(DataFrame.unionByName, out)


ABOVE = pa.list_(pa.struct([("at", pa.int32()), ("digests", pa.list_(pa.binary()))]))


def _leaf_paths(first: int, total: int, digests: bytes, keys: list[dict]) -> Iterator[list[tuple[int, list[str]]]]:
    """For each leaf of a chunk its way up: (position, digests of the run) of every level, the second tree's included."""
    stack = _stack(first, total, digests)
    runs = dict(stack.runs)
    for key in keys:
        for k, held in enumerate(key["inside"]):
            runs[key["level"] + k, key["run"] // FANOUT**k] = [d.hex() for d in held]
    above = [(e["at"], [d.hex() for d in e["digests"]]) for e in keys[0]["above"]]
    levels = len(stack.sizes) - 1
    for index in range(first, first + len(digests) // 32):
        way = []
        for level in range(levels):
            way.append((index % FANOUT, runs[level, index // FANOUT]))
            index //= FANOUT
        yield way + above


def _over_chunks(tree: Tree, above: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over chunks with ``keys``, what they need from outside of them: one or two rows for each chunk."""
    needs = tree.chunks.select("part", "serial", "grp", "total", "first", "digests").transform(map_batches, _needs, "part int, serial int, grp string, level int, run long")
    paths = _paths(tree, above)
    found = needs.join(paths, ["grp", "level", "run"]).groupBy("part", "serial").agg(F.collect_list(F.struct("level", "run", "inside", "above")).alias("keys"))
    return tree.chunks.join(found, ["part", "serial"]).select("first", "total", "ids", "digests", "others", "keys").transform(map_batches, run, schema)


def _chunk_rows(part: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(part.column(c).to_pylist() for c in ("first", "total", "ids", "digests", "others", "keys")), strict=True)


def _ways(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for first, total, ids, digests, _, keys in _chunk_rows(part):
            ways = [[{"at": at, "digests": [bytes.fromhex(d) for d in run]} for at, run in way] for way in _leaf_paths(first, total, digests, keys)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(ways, ABOVE)], ["grp", "above"])


def fold(leaf: str, way: list[tuple[int, list[str]]]) -> str:
    """The root over a leaf and the others of every run on its way up."""
    for at, run in way:
        leaf = join_hash([*run[:at], leaf, *run[at + 1 :]])
    return leaf


def _proofs(root: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, total, ids, digests, others, keys in _chunk_rows(part):
                out, subroot = [], None
                levels = len(level_sizes(total)) - 1
                for k, (key, way) in enumerate(zip(ids, _leaf_paths(first, total, digests, keys), strict=True)):
                    leaf = digests[32 * k : 32 * k + 32].hex()
                    proof = join_hash([d for at, held in way for j, d in enumerate(held) if j != at])
                    if subroot is None:
                        subroot = fold(leaf, way[:levels])
                    folded = fold(leaf if others[k] is None else others[k].hex(), way)
                    out.append((key, leaf, subroot, root, proof, folded, folded == root))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.int64(), *[pa.string()] * 5, pa.bool_()), strict=True)], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return run


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def dataset_manifest(docs: DataFrame, tampered: Column | None = None, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(proofs, nodes) of ``docs`` (doc_id, source, lang, n_chars, text, ...), grouped by lang, null first.

    ``proofs``: ``PROOF`` for each row, folded from the tampered leaf where ``tampered``. ``nodes``: grp, level, idx,
    digest of every node record within languages. Rows with a null doc_id come first in their language; rows that share a
    doc_id come in the order of their leaves; equal rows are leaves of their own. An empty table has no rows. Other
    columns are ignored.
    """
    first = build(leaf_digests(docs, F.lit(False) if tampered is None else tampered), ["id", "digest"], chunk)
    roots = first.tops.select(F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("top").alias("digest"), F.lit(None).cast("binary").alias("other"))
    second = build(roots, ["id"], chunk)
    top = second.tops.first()
    nothing = docs.sparkSession.createDataFrame([("", [])], "grp string, above array<struct<at int, digests array<binary>>>")
    ways = materialize(_over_chunks(second, nothing, _ways, "grp string, above array<struct<at int, digests array<binary>>>"), "ways")
    proofs = _over_chunks(first, ways, _proofs(bytes(top.top).hex() if top else ""), PROOF)
    merged = [r.select("grp", (F.col("level") + 1).alias("level"), F.col("run").alias("idx"), F.unhex(F.sha2(F.array_join(F.transform("digests", lambda d: F.lower(F.hex(d))), ""), 256)).alias("digest")) for r in first.runs]
    nodes = reduce(DataFrame.unionByName, merged, first.records.where("level > 0").select("grp", "level", "idx", "digest"))
    return proofs, nodes


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dataset_manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 0)[0]


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
      || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head
  FROM documents),
crc AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS rest
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
leaves AS (
  SELECT d.doc_id, coalesce(':' || lang, '') AS grp,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    CASE WHEN xor(crc.rest, 4294967295) % 3 = 0 THEN
      sha256(head || CASE WHEN text IS NULL THEN '-'
        ELSE strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END) END AS other
  FROM d LEFT JOIN crc ON crc.doc_id = d.doc_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
low AS (
  SELECT grp, 0 AS level, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT grp, level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY grp, level, i // 8),
subroots AS (
  SELECT grp, h, row_number() OVER (ORDER BY encode(grp)) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 8),
steps AS (
  SELECT p.grp, p.i AS leaf_i, a.level, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i) AS l, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i) AS r
  FROM placed p JOIN low a ON a.grp = p.grp AND a.n > 1 AND a.i = p.i // (8 ** a.level)::BIGINT
  JOIN low b ON b.grp = a.grp AND b.level = a.level AND b.i // 8 = a.i // 8
  GROUP BY p.grp, p.i, a.level
  UNION ALL
  SELECT p.grp, p.i, 1000 + a.level, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i)
  FROM placed p JOIN subroots s ON s.grp = p.grp JOIN high a ON a.n > 1 AND a.i = s.i // (8 ** a.level)::BIGINT
  JOIN high b ON b.level = a.level AND b.i // 8 = a.i // 8
  GROUP BY p.grp, p.i, a.level),
ways AS (
  SELECT grp, leaf_i, coalesce(l, '') AS l, coalesce(r, '') AS r, row_number() OVER (PARTITION BY grp, leaf_i ORDER BY level) AS step FROM steps),
folds AS (
  SELECT grp, i AS leaf_i, 0 AS step, coalesce(other, leaf) AS h FROM placed
  UNION ALL
  SELECT w.grp, w.leaf_i, w.step, sha256(w.l || f.h || w.r) FROM folds f JOIN ways w ON w.grp = f.grp AND w.leaf_i = f.leaf_i AND w.step = f.step + 1),
folded AS (SELECT grp, leaf_i, max_by(h, step) AS h FROM folds GROUP BY grp, leaf_i),
proofs AS (SELECT grp, leaf_i, sha256(string_agg(l || r, '' ORDER BY step)) AS h FROM ways GROUP BY grp, leaf_i)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, coalesce(q.h, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM placed p JOIN subroots s ON s.grp = p.grp JOIN folded f ON f.grp = p.grp AND f.leaf_i = p.i
LEFT JOIN proofs q ON q.grp = p.grp AND q.leaf_i = p.i CROSS JOIN (SELECT h FROM high WHERE n = 1) t
"""
