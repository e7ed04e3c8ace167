"""Spark data sources over files of any store that Arrow opens: text dumps by byte range, and recordings that may not be readable.

``topic_dumps`` splits a dump into byte ranges; a message belongs to the range in which its header begins, so a reader starts at
the first header in its range and reads on past the end to finish its last message. Only the columns of the schema
asked for are made. ``recording_files`` reads one file a task, tries again where that fails, and then gives one row that
says why instead of data, so one bad file costs itself and not the job.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SPLIT_BYTES = 64 << 20
#: Bytes that a reader looks at beyond its range at first for the next header; doubled until it is there.
LOOK = 64 << 10
MESSAGES = "path string, position long, stamp string, paragraph string"


def _store(path: str):
    """(file system, path within it) of a URI or a plain path."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def listed(paths: list[str], suffix: str = "") -> list[tuple[str, int]]:
    """(path, size) of the files at ``paths``; of folders, those at any depth whose name ends in ``suffix``. Sorted by path."""
    from pyarrow import fs

    out = []
    for path in paths:
        store, inner = _store(path)
        info = store.get_file_info(inner)
        if info.type == fs.FileType.Directory:
            head = path[: len(path) - len(inner)] if path.endswith(inner) else ""
            found = store.get_file_info(fs.FileSelector(inner, recursive=True))
            out += [(head + f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix)]
        else:
            out.append((path, info.size or 0))
    return sorted(set(out))


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


def byte_ranges(files: list[tuple[str, int]], size: int) -> list[ByteRange]:
    return [ByteRange(path, a, min(a + size, n)) for path, n in files for a in range(0, n, size)]


def messages_of(file, marker: str, start: int, end: int) -> Iterator[tuple[int, bytes, bytes, bool]]:
    """(offset, stamp, body, last of the file) of the messages whose header begins in [start, end) of an open file."""
    head = re.compile(rb"([0-9]{19})\s+" + re.escape(marker.encode()) + rb":\s*")
    total, cut, look = file.size(), end - start, LOOK
    file.seek(start)
    data = file.read(cut + look)
    while True:
        whole = start + len(data) >= total
        heads = list(head.finditer(data))
        if whole or any(m.start() >= cut and m.end() < len(data) for m in heads):
            break
        data += file.read(look)
        look *= 2
    for k, m in enumerate(heads):
        if m.start() >= cut:
            return
        last = k + 1 == len(heads)
        yield start + m.start(), m[1], data[m.end() : None if last else heads[k + 1].start()], last


def valid_utf8(file, start: int, end: int) -> bool:
    """Whether the characters that begin in [start, end) are UTF-8; a character over the end is read whole."""
    file.seek(start)
    data, goes_on = file.read(end - start + 3), lambda b: 0x80 <= b < 0xC0
    first, stop = 0, min(end - start, len(data))
    while start and first < min(3, len(data)) and goes_on(data[first]):
        first += 1
    while stop < len(data) and goes_on(data[stop]):
        stop += 1
    try:
        data[first:stop].decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def as_text(body: bytes, encoding: str, last: bool) -> str:
    """A message's text: line ends are line feeds, and white space at its end goes but for the last of a file."""
    text = body.decode(encoding, "strict" if encoding == "utf-8" else "ignore").replace("\r\n", "\n").replace("\r", "\n")
    return text if last else text.rstrip()


class _DumpReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.files = [tuple(f) for f in json.loads(options["files"])]
        self.size = int(options.get("splitbytes", SPLIT_BYTES))
        self.marker = options.get("marker", "header")
        self.other = set(json.loads(options.get("gbk", "[]")))
        self.check = options.get("check", "false") == "true"
        self.columns = schema.names

    def partitions(self) -> list[InputPartition]:
        return byte_ranges(self.files, self.size) or [ByteRange("", 0, 0)]

    def read(self, part: ByteRange) -> Iterator[tuple]:
        if not part.path:
            return
        store, inner = _store(part.path)
        with store.open_input_file(inner) as file:
            if self.check:
                yield part.path, valid_utf8(file, part.start, part.end)
                return
            encoding = "gbk" if part.path in self.other else "utf-8"
            make = {"path": lambda m: part.path, "position": lambda m: m[0], "stamp": lambda m: m[1].decode(), "paragraph": lambda m: as_text(m[2], encoding, m[3])}
            wanted = [make[c] for c in self.columns]
            for message in messages_of(file, self.marker, part.start, part.end):
                yield tuple(f(message) for f in wanted)


class TopicDumps(DataSource):
    """Options: files (JSON list of path and size), marker, splitbytes, gbk (JSON list of paths), check."""

    @classmethod
    def name(cls) -> str:
        return "topic_dumps"

    def schema(self) -> str:
        return "path string, valid boolean" if self.options.get("check") == "true" else MESSAGES

    def reader(self, schema: StructType) -> DataSourceReader:
        return _DumpReader(dict(self.options), schema)


def read_messages(spark: SparkSession, paths: list[str], marker: str, columns: str = MESSAGES, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The messages of dumps: ``columns`` of path, position (byte offset of the header), stamp and paragraph.

    A file that isn't UTF-8 throughout is GBK, undecodable bytes left out; ranges of all files are looked at for that first, one
    row for each file tells. What comes before a file's first header is no message. Empty files have none.
    """
    spark.dataSource.register(TopicDumps)
    files = listed(paths, ".txt")
    source = lambda: spark.read.format("topic_dumps").option("files", json.dumps(files)).option("splitbytes", split_bytes).option("marker", marker)
    other: list[str] = []
    if "paragraph" in columns:
        checked = source().option("check", "true").load()
        other = [r.path for r in checked.groupBy("path").agg(F.bool_and("valid").alias("valid")).where("not valid").collect()]
    return source().option("gbk", json.dumps(other)).schema(columns).load()


# Recordings


@dataclass
class OneFile(InputPartition):
    path: str


class _RecordingReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.files = json.loads(options["files"])
        self.retries, self.delay = int(options.get("retries", 2)), float(options.get("delay", 2.0))
        self.columns = schema.names[:-3]

    def partitions(self) -> list[InputPartition]:
        return [OneFile(f) for f in self.files] or [OneFile("")]

    def read(self, part: OneFile) -> Iterator[tuple]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        if not part.path:
            return
        for attempt in range(self.retries + 1):
            try:
                store, inner = _store(part.path)
                with store.open_input_file(inner) as file:
                    table = pq.ParquetFile(file)
                    have = [c for c in self.columns if c in table.schema_arrow.names]
                    data = table.read(columns=have)  # whole before a row goes out, so a file that breaks gives none
                break
            except (OSError, pa.ArrowInvalid) as error:
                if attempt == self.retries:
                    yield (*(None for _ in self.columns), part.path, type(error).__name__, str(error))
                    return
                time.sleep(self.delay)
        for batch in data.to_batches():
            own = {c: batch.column(c).to_pylist() for c in have}
            none = [None] * batch.num_rows
            for row in zip(*(own.get(c, none) for c in self.columns), strict=True):
                yield (*row, part.path, None, None)


class RecordingFiles(DataSource):
    """Options: files (JSON list of paths), retries, delay (s). The last columns of the schema are src_path, error_type, error."""

    @classmethod
    def name(cls) -> str:
        return "recording_files"

    def schema(self) -> str:
        raise ValueError("recording_files needs a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _RecordingReader(dict(self.options), schema)


def read_recordings(spark: SparkSession, files: list[str], columns: str, retries: int = 2, delay: float = 2.0) -> DataFrame:
    """Rows of ``columns`` from Parquet recordings with src_path; where a file can't be read after ``retries`` more attempts, one
    row of nulls with error_type and error stands for it. Columns that a file lacks are null."""
    spark.dataSource.register(RecordingFiles)
    return spark.read.format("recording_files").option("files", json.dumps(files)).option("retries", retries).option("delay", delay).schema(f"{columns}, src_path string, error_type string, error string").load()


def parted(rows: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(data, recordings) of ``read_recordings``: ``files`` (src_path, ...) with ok, error_type and error. Both read ``rows``: write them first.

    Recordings that failed stay in the list without samples, so nothing is stitched over them (``plans.stitched``), and
    ``recordings.manifest`` calls the run incomplete.
    """
    failed = rows.where("error_type is not null").select("src_path", "error_type", "error")
    listed_ = files.join(failed, "src_path", "left").withColumn("ok", F.col("error_type").isNull())
    return rows.where("error_type is null").drop("error_type", "error"), listed_
