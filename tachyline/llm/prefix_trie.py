"""The trie of conversation prefixes: which conversations begin alike, and how many words a shared prefix cache saves.

Turns get a 64-bit hash of role and text, and a prefix the polynomial sum of its turns' hashes, modulo 2**64. Sums run over
rows that are dealt out by ranges of (conversation, position) and scanned by numpy; one row for each range carries
what a conversation had in earlier ranges, so a conversation of any length is split over tasks (``running_sums``).

Prefixes of one depth and fingerprint are candidates for one node. The smallest conversation represents the group, and
every other member's turn is compared, as text, with the representative's turn of that depth; members that differ, in
the turn or in the node before it, become groups of their own, round after round until all agree. A group whose turns all
agree is a node: its members' earlier turns agree by the same test one depth before.

A node is known by its smallest member and its depth, and the nodes of one smallest member are a path. Paths hang on one
another; their totals are added up along doubling jumps, and the sums of a node are running sums over its path from below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import U64, map_batches, materialize

BASE = U64(0xD1342543DE82EF95)
#: Conversations of one family share the first turns of the one whose identifier is a multiple of this.
FAMILY, HEADS = 20, 4
#: Rows that one key of a lookup may bring into one task before its rows are salted; at most 1,000 keys have so many.
HOT = 4096


def power(n: np.ndarray) -> np.ndarray:
    """BASE ** n modulo 2**64, for whole numbers of either sign (BASE is odd, so it has an inverse)."""
    inverse = U64(pow(int(BASE), -1, 2**64))
    out, left = np.ones(len(n), np.uint64), np.abs(n).astype(np.uint64)
    step = np.where(n < 0, inverse, BASE)
    while left.any():
        out = np.where(left & U64(1), out * step, out)
        step, left = step * step, left >> U64(1)
    return out


def _scan(key: str, names: list[str]):
    """Rows sorted by key -> with ``part``, ``at`` (number in the part), ``first`` (of the part's first key) and running sums within the part."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at, last, first, sums = TaskContext.get().partitionId(), 0, None, None, np.zeros(len(names), np.uint64)
        for part in parts:
            if not part.num_rows:
                continue
            keys = part.column(key).to_numpy(zero_copy_only=False).astype(np.int64)
            first = keys[0] if first is None else first
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            run_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
            new = []
            for k, name in enumerate(names):
                value = part.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                total = np.cumsum(value)
                before = (total - value)[starts]
                if keys[0] == last:
                    before[0] -= sums[k]
                total = total - before[run_of]
                sums[k] = total[-1]
                new.append(pa.array(total.view(np.int64)))
            last, n = keys[-1], len(keys)
            own = [part.column(c) for c in part.schema.names if c not in names]
            yield pa.RecordBatch.from_arrays([*own, *new, pa.array(np.full(n, task, np.int32)), pa.array(np.arange(at, at + n)), pa.array(keys == first)], [*(c for c in part.schema.names if c not in names), *names, "part", "at", "first"])
            at += n

    return run


def running_sums(rows: DataFrame, key: str, order: list[Column], names: list[str]) -> DataFrame:
    """``rows`` with each of ``names`` (long, not null) replaced by its running sum, modulo 2**64, within ``key`` by ``order``.

    Rows are sorted by ranges, so a key with any number of rows is split; its sums go on by a fold over one row for each
    range. Ties in ``order`` come in any order.
    """
    salted = rows.withColumn("at", F.monotonically_increasing_id())
    by = [F.col(key), *order, F.col("at")]
    kept = [c for c in rows.columns if c not in names]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), *(f"`{c}` long" for c in names), "part int, at long, first boolean"])
    local = materialize(map_batches(salted.repartitionByRange(*by).sortWithinPartitions(*by).select(*kept, *names), _scan(key, names), schema), "scan")
    ends = local.groupBy("part").agg(F.min_by(key, "at").alias("low"), F.max_by(F.struct(key, *names), "at").alias("high")).orderBy("part").collect()
    carry, held, sums = {}, None, [0] * len(names)
    for end in ends:  # one row for each range of the sort
        if held == end.low:
            carry[end.part] = list(sums)
        else:
            sums = [0] * len(names)
        own = list(end.high)[1:]
        sums = [(a + b) % 2**64 for a, b in zip(sums, own, strict=True)] if end.low == end.high[0] else [b % 2**64 for b in own]
        held = end.high[0]
    if not carry:
        return local.drop("part", "at", "first")

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            task, more = part.column("part").to_numpy(), part.column("first").to_numpy(zero_copy_only=False)
            ids = np.unique(task)
            columns = [part.column(c) for c in kept]
            for k, name in enumerate(names):
                extra = np.array([carry[t][k] if t in carry else 0 for t in ids.tolist()], np.uint64)
                value = part.column(name).to_numpy().view(np.uint64) + np.where(more, extra[np.searchsorted(ids, task)], U64(0))
                columns.append(pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return map_batches(local, add, ", ".join([*(f"`{c}` {types[c]}" for c in kept), *(f"`{c}` long" for c in names)]))


def lookup(rows: DataFrame, table: DataFrame, on: list[str], counts: DataFrame, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, unique by ``on``. ``counts`` (on, n) tells how many rows each key has.

    Keys of over ``HOT`` rows, and over a thousandth of all ``total``, are at most 1,000: that table is broadcast, the
    rows of these keys are salted, and their row of ``table`` is repeated once for each salt.
    """
    least = max(HOT, total // 1000)
    hot = F.broadcast(counts.where(F.col("n") > least).select(*on, F.ceil(F.col("n") / least).cast("int").alias("__salts")))
    salt = F.coalesce(F.expr("cast(pmod(monotonically_increasing_id(), __salts) as int)"), F.lit(0))
    left = rows.join(hot, on, "left").withColumn("__salt", salt).drop("__salts")
    right = table.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))).drop("__salts")
    return left.join(right, [*on, "__salt"]).drop("__salt")


def shared_heads(conv_id: Column) -> Column:
    """How many first turns of its family's first conversation a conversation takes over."""
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def _turn_hash(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the hash of (role, text): two 64-bit halves of a digest, mixed, so that equal turns have equal hashes."""
    for part in parts:
        roles, texts = (part.column(c).to_pylist() for c in ("role", "text"))
        digest = [int.from_bytes(hashlib.blake2b(f"{len(r)}:{r}{t}".encode(), digest_size=8).digest(), "little", signed=True) for r, t in zip(roles, texts, strict=True)]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(digest, pa.int64())], [*part.schema.names, "turn_hash"])


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text, ...) -> conv_id, pos (from 1), role, text, words, turn_hash, written once.

    Rows come by turn, null first; rows of one turn by the MD5 of role, newline and text. Null role and text are empty; rows
    without conv_id are left out. Other columns are ignored.
    """
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.md5(F.concat_ws("\n", "role", "text"))).withColumn("pos", F.lit(1).cast("long"))
    placed = running_sums(rows, "conv_id", [F.asc_nulls_first("turn"), F.col("tie")], ["pos"])
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    return materialize(map_batches(placed.select("conv_id", "pos", "role", "text", words.alias("words")), _turn_hash, "conv_id long, pos long, role string, text string, words long, turn_hash long"), "turns")


def rebuilt(turns: DataFrame, heads: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(prefixes, lengths) of the rebuilt conversations of ``turns_in_order``.

    A conversation c begins with the first h turns of conversation c - c % 20 (all if it has fewer, none if it is absent) and
    goes on after its own first h. ``prefixes``: conv_id, depth, fp, words (of the last turn), src and src_pos (where
    that turn is among ``turns``). ``lengths``: conv_id and length of each, those without a turn included.
    """
    h = shared_heads(F.col("conv_id")) if heads is None else heads
    family = F.expr(f"conv_id - conv_id % {FAMILY}")
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("family", family).withColumn("h", F.when(F.col("family") == F.col("conv_id"), 0).otherwise(h))
    slim = turns.select("conv_id", "pos", "words", "turn_hash")
    firsts = slim.where(f"conv_id % {FAMILY} = 0").where(F.col("pos") < HEADS)
    taken = convs.where("h > 0").select("conv_id", "family", "h").join(firsts.withColumnRenamed("conv_id", "family"), "family").where("pos <= h")
    taken = taken.select("conv_id", "pos", "words", "turn_hash", F.col("family").alias("src"), F.lit(1).cast("long").alias("taken"))
    kept = slim.withColumn("h", F.when(family == F.col("conv_id"), 0).otherwise(h)).where("pos > h").select("conv_id", "pos", "words", "turn_hash", F.col("conv_id").alias("src"), F.lit(0).cast("long").alias("taken"))
    rows = taken.unionByName(kept).withColumn("h", F.when(family == F.col("conv_id"), 0).otherwise(h).cast("int"))

    def terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            conv, pos, words, turn, src, taken, h = part.columns
            term = (turn.to_numpy().view(np.uint64) * power(pos.to_numpy())).view(np.int64)
            is_taken = taken.to_numpy()
            yield pa.RecordBatch.from_arrays([conv, pos, words, src, h, taken, pa.array(1 - is_taken), pa.array(term * is_taken), pa.array(term * (1 - is_taken))], ["conv_id", "pos", "words", "src", "h", "taken", "kept", "fp_taken", "fp_kept"])

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            taken, kept, h = (part.column(c).to_numpy() for c in ("taken", "kept", "h"))
            a, b = (part.column(c).to_numpy().view(np.uint64) for c in ("fp_taken", "fp_kept"))
            fp = a + b * power(taken - h)  # kept turns move from their own position to the one after what was taken
            yield pa.RecordBatch.from_arrays([part.column("conv_id"), pa.array(taken + kept), pa.array(fp.view(np.int64)), part.column("words"), part.column("src"), part.column("pos")], ["conv_id", "depth", "fp", "words", "src", "src_pos"])

    rows = map_batches(rows.select("conv_id", "pos", "words", "turn_hash", "src", "taken", "h"), terms, "conv_id long, pos long, words long, src long, h int, taken long, kept long, fp_taken long, fp_kept long")
    summed = running_sums(rows.withColumn("own", 1 - F.col("taken")), "conv_id", [F.col("own"), F.col("pos")], ["taken", "kept", "fp_taken", "fp_kept"])
    prefixes = materialize(map_batches(summed.drop("own"), finish, "conv_id long, depth long, fp long, words long, src long, src_pos long"), "prefixes")
    lengths = convs.select("conv_id").join(prefixes.groupBy("conv_id").agg(F.max("depth").alias("length")), "conv_id", "left").select("conv_id", F.coalesce("length", F.lit(0).cast("long")).alias("length"))
    return prefixes, materialize(lengths, "lengths")


LABEL = ["depth", "fp", "split"]


def verified(prefixes: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels, groups): ``prefixes`` with ``split``, so that rows of equal (depth, fp, split) have equal turns, and their groups
    with rep (the smallest conversation) and n. Rounds go on until no member differs from its representative."""
    total, splits, turn = prefixes.count(), None, 0
    while True:
        labels = prefixes.withColumn("split", F.lit(0)) if splits is None else prefixes.join(splits, ["conv_id", "depth"], "left").withColumn("split", F.coalesce("split", F.lit(0)))
        labels = labels if splits is None else materialize(labels, "labels")
        groups = materialize(labels.groupBy(*LABEL).agg(F.min("conv_id").alias("rep"), F.count("*").alias("n")), "groups")
        own = labels
        if splits is not None:  # the node before: its label's fingerprint is equal where the turns are, its split may differ
            own = labels.join(labels.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("split").alias("up")), ["conv_id", "depth"], "left")
        own = own.withColumn("up", F.coalesce("up", F.lit(0))) if splits is not None else own.withColumn("up", F.lit(0))
        several = groups.where("n > 1")
        heads = several.join(own.select(F.col("conv_id").alias("rep"), *LABEL, F.col("src").alias("rep_src"), F.col("src_pos").alias("rep_pos"), F.col("up").alias("rep_up")), ["rep", *LABEL]).drop("n")
        pairs = materialize(lookup(own.select("conv_id", *LABEL, "src", "src_pos", "up"), heads, LABEL, several, total).where("conv_id <> rep"), "pairs")
        texts = pairs.where("src <> rep_src or src_pos <> rep_pos").select("src", "src_pos", "rep_src", "rep_pos").distinct()
        texts = texts.join(turns.select(F.col("conv_id").alias("src"), F.col("pos").alias("src_pos"), F.col("role").alias("a_role"), F.col("text").alias("a_text")), ["src", "src_pos"])
        heard = materialize(pairs.where("src <> rep_src or src_pos <> rep_pos").select("src", "src_pos", "rep_src", "rep_pos").distinct().groupBy("rep_src", "rep_pos").agg(F.count("*").alias("n")), "heard")
        said = turns.select(F.col("conv_id").alias("rep_src"), F.col("pos").alias("rep_pos"), F.col("role").alias("b_role"), F.col("text").alias("b_text")).join(heard.select("rep_src", "rep_pos"), ["rep_src", "rep_pos"], "left_semi")
        wrong = lookup(texts, said, ["rep_src", "rep_pos"], heard, total).where("a_role <> b_role or a_text <> b_text").select("src", "src_pos", "rep_src", "rep_pos", F.lit(True).alias("wrong"))
        bad = pairs.join(wrong, ["src", "src_pos", "rep_src", "rep_pos"], "left").where("wrong or up <> rep_up").select("conv_id", "depth")
        bad = materialize(bad, "collisions")
        if bad.isEmpty():
            return labels, groups
        turn += 1
        new = bad.withColumn("split", F.lit(turn))
        splits = new if splits is None else splits.join(bad, ["conv_id", "depth"], "left_anti").unionByName(new)
        splits = materialize(splits, "splits")


def _ends(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation -> the digest of each node's identifiers; one running digest is held."""
    node, digest = None, hashlib.sha256()
    types = [("rep", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())]
    for part in parts:
        rep, depth, conv = (part.column(c).to_numpy() for c in ("rep", "depth", "conv_id"))
        cuts = np.flatnonzero((np.diff(rep) != 0) | (np.diff(depth) != 0)) + 1
        out = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rep)], strict=True):
            if a == b:
                continue
            now = (int(rep[a]), int(depth[a]))
            text = ",".join(map(str, conv[a:b].tolist())).encode()
            if now == node:
                digest.update(b"," + text)
            else:
                out += [(*node, digest.hexdigest())] if node else []
                node, digest = now, hashlib.sha256(text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*out, strict=True), types, strict=True)], [n for n, _ in types])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip((*node, digest.hexdigest()), types, strict=True)], [n for n, _ in types])


def _path_totals(paths: DataFrame, root: int) -> DataFrame:
    """``paths`` (rep, up, leaves, saved) -> rep, leaves, saved with all paths below added, along doubling jumps."""
    state, total = paths, paths.count()
    while True:
        counts = materialize(state.where("up is not null").groupBy("up").agg(F.count("*").alias("n"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")), "jumps")
        if counts.isEmpty():
            return state.select("rep", "leaves", "saved")
        sums = state.join(counts.drop("n").withColumnRenamed("up", "rep"), "rep", "left").select("rep", "up", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        done = sums.where(F.col("up").isNull() | (F.col("up") == root)).withColumn("up", F.lit(None).cast("long"))
        next_up = state.select(F.col("rep").alias("up"), F.col("up").alias("next"))
        going = lookup(sums.where(F.col("up") != root), next_up, ["up"], counts.where(F.col("up") != root).select("up", "n"), total).select("rep", F.col("next").alias("up"), "leaves", "saved")
        state = materialize(done.unionByName(going), "totals")


def prefix_trie(conversations: DataFrame, heads: Column | None = None) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text, ...) -> one row for each node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Nulls,
    ties and repeated rows as in ``turns_in_order``; conversations without turns are members of the root alone; an empty
    table has no node. A node's ``ends_sha256`` is one running digest, which can't be split: the identifiers that end
    at one node stream through one task, whatever their number.
    """
    turns = turns_in_order(conversations)
    prefixes, lengths = rebuilt(turns, heads)
    root = lengths.agg(F.min("conv_id"), F.count("*")).first()
    if root[0] is None:
        return conversations.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    labels, groups = verified(prefixes, turns)
    total = root[1]
    # A representative's words are those of its own row.
    nodes = groups.join(labels.select(F.col("conv_id").alias("rep"), *LABEL, "words"), ["rep", *LABEL]).select("rep", *LABEL, "n", ((F.col("n") - 1) * F.col("words")).alias("saved"))
    nodes = materialize(nodes, "nodes")
    tops = nodes.groupBy("rep").agg(F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("saved").alias("saved"))
    before = tops.where("top > 1").select("rep", (F.col("top") - 1).alias("depth")).join(labels.select(F.col("conv_id").alias("rep"), *LABEL), ["rep", "depth"])
    counts = materialize(before.groupBy(*LABEL).agg(F.count("*").alias("n")), "parents")
    hung = lookup(before, groups.select(*LABEL, F.col("rep").alias("up")), LABEL, counts, total).select("rep", "up", F.col("depth").alias("at"))
    first = tops.where((F.col("top") == 1) & (F.col("rep") != root[0])).select("rep", F.lit(root[0]).alias("up"), F.lit(0).cast("long").alias("at"))
    hung = materialize(hung.unionByName(first), "hung")
    branches = hung.groupBy(F.col("up").alias("rep"), F.col("at").alias("depth")).agg(F.count("*").alias("branches"))
    # The root is a node of the smallest conversation's path, though that one may have no turn.
    paths = tops.select("rep", "bottom", "saved").unionByName(lengths.where(F.col("conv_id") == root[0]).select(F.col("conv_id").alias("rep"), F.lit(0).cast("long").alias("bottom"), F.lit(0).cast("long").alias("saved"))).groupBy("rep").agg(F.max("bottom").alias("bottom"), F.sum("saved").alias("saved"))
    ends = paths.join(branches, (branches["rep"] == paths["rep"]) & (branches["depth"] == paths["bottom"]), "left").select(paths["rep"], "bottom", "saved", F.when(F.col("branches").isNull(), 1).otherwise(0).cast("long").alias("leaf"))
    paths = materialize(ends.join(hung.select("rep", "up"), "rep", "left"), "paths")
    totals = _path_totals(paths.select("rep", "up", F.col("leaf").alias("leaves"), "saved"), root[0])
    below = hung.join(totals, "rep").groupBy(F.col("up").alias("rep"), F.col("at").alias("depth")).agg(F.count("*").alias("branches"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("more"))
    zero = F.lit(0).cast("long")
    every = nodes.select("rep", "depth", "n", "saved").unionByName(lengths.where(F.col("conv_id") == root[0]).select(F.col("conv_id").alias("rep"), zero.alias("depth"), F.lit(total).cast("long").alias("n"), zero.alias("saved")))
    leaf = paths.where("leaf = 1").select("rep", F.col("bottom").alias("depth"), F.col("leaf"))
    every = every.join(below, ["rep", "depth"], "left").join(leaf, ["rep", "depth"], "left")
    every = every.select("rep", "depth", "n", F.coalesce("branches", zero).alias("branches"), (F.coalesce("leaves", zero) + F.coalesce("leaf", zero)).alias("n_leaves"), (F.col("saved") + F.coalesce("more", zero)).alias("saved_tokens"), F.lit(1).cast("long").alias("deeper"))
    every = running_sums(every, "rep", [F.desc("depth")], ["n_leaves", "saved_tokens", "deeper"])
    every = every.join(hung.select("rep", F.col("up"), (F.col("at") + 1).alias("depth")), ["rep", "depth"], "left")
    last = labels.select("conv_id", *LABEL).join(lengths.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
    sizes = materialize(last.groupBy(*LABEL).agg(F.count("*").alias("n")), "last")
    last = lookup(last, groups.select(*LABEL, "rep"), LABEL, sizes, total).select("rep", "depth", "conv_id").unionByName(lengths.where("length = 0").select(F.lit(root[0]).alias("rep"), zero.alias("depth"), "conv_id"))
    ends = map_batches(last.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "conv_id"), _ends, "rep long, depth long, ends_sha256 string")
    return every.join(ends, ["rep", "depth"], "left").select(
        F.col("rep").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("up", "rep")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("branches") + F.when(F.col("deeper") > 1, 1).otherwise(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Per node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || chr(10) || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS family,
    list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS rest
  FROM (SELECT DISTINCT conv_id FROM t)),
h AS (SELECT conv_id, family, xor(rest, 4294967295) % 4 AS h FROM c),
b AS (
  SELECT h.conv_id, 0 AS own, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.family WHERE t.pos <= h.h
  UNION ALL
  SELECT h.conv_id, 1, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id WHERE t.pos > h.h),
s AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY own, pos) AS turns FROM b GROUP BY conv_id),
r AS (SELECT h.conv_id, coalesce(s.turns, []) AS turns FROM h LEFT JOIN s ON s.conv_id = h.conv_id),
p AS (SELECT conv_id, len(turns) AS length, d AS depth, turns[1:d] AS prefix FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(prefix[depth].text, '[^\x20\x09-\x0D]+')) END AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, prefix),
k AS (SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.depth = n.depth AND k.prefix = n.prefix),
u AS (SELECT prefix[1:d] AS prefix, d AS depth, saved, n_children FROM (SELECT prefix, saved, n_children, unnest(range(depth + 1)) AS d FROM m)),
w AS (SELECT depth, prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM u GROUP BY depth, prefix)
SELECT m.conv_id, m.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children::BIGINT AS n_children, w.n_leaves, w.saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM m JOIN w ON w.depth = m.depth AND w.prefix = m.prefix LEFT JOIN n q ON q.depth = m.depth - 1 AND q.prefix = m.prefix[1:m.depth - 1]
"""
