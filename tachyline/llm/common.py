"""What several operators share: scratch tables on shared storage, and numpy kernels over batches of texts.

The kernels take Arrow string columns, see them as one byte array with document offsets, and work on
chunks of a few MB, so a task's memory doesn't depend on the size of its partition.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a kernel works on at a time; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20
#: Bytes of an Arrow batch that a task is handed, at most; a longer row is a batch of its own.
BATCH_BYTES = 8 << 20
U64 = np.uint64


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Where a local session names none (tests), a temporary folder becomes the checkpoint folder; a cluster must name one.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="scratch")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def row_key() -> Column:
    """16 bytes that stand for a row's doc_id and text: a digest, so that rows with different texts don't meet."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.when(F.col("text").isNull(), "-").otherwise(":"), F.coalesce("text", F.lit("")))))


def materialize(df: DataFrame, name: str, sort: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    (df.sortWithinPartitions(*sort) if sort else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches of ``BATCH_BYTES`` at most: the session's limit is lowered to that where it is higher."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", conf.get(name))
    if not now or int(now[1]) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


#: Bits of a ``key_filter``; its table has one row for 64 bits at most, whatever the number of keys.
FILTER_BITS = 1 << 24


def key_filter(keys: DataFrame, column: str = "key") -> DataFrame:
    """A table (word, bits) of a fixed size at most that tells which keys surely aren't among ``keys``."""
    slot = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    return keys.select(slot.alias("slot")).groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(slot % 64))")).alias("bits"))


def by_filter(rows: DataFrame, table: DataFrame, column: str = "key", maybe: bool = True) -> DataFrame:
    """The rows whose key may be among those of a ``key_filter``, or the others. The table's size is bounded, so it is broadcast."""
    slot = F.pmod(F.xxhash64(rows[column]), F.lit(FILTER_BITS))
    meets = (F.floor(slot / 64) == table["word"]) & (F.call_function("shiftright", table["bits"], (slot % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return rows.join(F.broadcast(table), meets, "left_semi" if maybe else "left_anti")


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and row offsets. Null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes and ``rows`` rows each, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits look independent."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def classes(*, space: bool = False, members: bytes = b"") -> np.ndarray:
    """A table of 256 booleans."""
    table = np.zeros(256, bool)
    table[list(b" \t\n\v\f\r" if space else members)] = True
    return table


SPACE = classes(space=True)


class Hasher:
    """Polynomial hashes, modulo 2**64, of any ranges of a byte array after one pass over it."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, seed: int = 11):
        self.letters = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            inverse = pow(self.BASE, -1, 2**64)
            self.power, self.inverse = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, b & (2**64 - 1), np.uint64)])) for b in (self.BASE, inverse))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.power[: len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.inverse[start])


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = ~SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``letters`` (all but ASCII white space), and each row's range of them."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, np.zeros(len(offsets), np.int64)
    inside = letters[data]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[first] = inside[first]
    ends[:-1] &= ~inside[1:]
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def shingles(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Each row's distinct hashes of ``size`` successive words in lower case (ASCII), ascending.

    A row with fewer words has the hash of its whole sequence; one without words has none.
    """
    data = LOWER[data]
    start, end, rows = words(data, offsets)
    word = hasher.ranges(hasher.prefix(data), start, end)
    factors = [U64(f | 1) for f in (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x589965CC75374CC3)]
    n = len(word)
    if n >= size:
        whole = word[: n - size + 1] * factors[0]
        for k in range(1, size):
            whole += word[k : n - size + 1 + k] * factors[k % 5]
        whole = mix(whole)
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            h = U64(b - a)
            with np.errstate(over="ignore"):
                for k in range(a, b):
                    h = mix(np.array([h * factors[1] + word[k]]))[0]
            out.append(np.array([h]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
