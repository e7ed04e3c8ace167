"""Secret scan: fixed patterns, and a battery of randomness tests with false-discovery control.

Strings of 20 or more token characters are candidates. For each, the encoding is inferred from the characters
used, and three statistics are held against what words, identifiers and paths of that length would give:
chi-squared distance from a uniform alphabet, runs of character classes, and serial correlation of successive
positions in the alphabet. Their normal scores are added (dependence allowed for) to one p-value of "made like
words". Candidates are grouped by encoding and length, and in each group the Benjamini-Hochberg step-up rule over
the whole corpus sets the largest p-value that counts as a discovery. The p-values meet in a histogram with a
fixed number of bins, so what is gathered doesn't grow with the corpus.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, classes, map_batches, texts_of, words

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
KEYWORDS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = classes(members=b"0123456789abcdef")
UPPER, LOWER, DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
TOKEN = classes(members=UPPER + LOWER + DIGIT + b"+/_=-")
MIN_TOKEN = 20
BINS, BIN_WIDTH = 400, 0.1
LENGTHS = (32, 48, 64, 128)
#: Encodings by their alphabets, narrowest first; excess of squared frequencies, class switches and correlation of words written in them.
ENCODINGS = (
    ("hex", DIGIT + b"abcdef", 0.6, 0.10, 0.5),
    ("hex_upper", DIGIT + b"ABCDEF", 0.6, 0.10, 0.5),
    ("lower", LOWER, 0.75, 0.60, -0.3),
    ("base32", UPPER + b"234567", 1.0, 0.10, 0.3),
    ("base36", LOWER + DIGIT, 1.4, 0.12, 0.5),
    ("base62", UPPER + LOWER + DIGIT, 2.6, 0.15, 0.5),
    ("base64", UPPER + LOWER + DIGIT + b"+/", 2.6, 0.18, 0.5),
    ("base64url", UPPER + LOWER + DIGIT + b"-_", 2.6, 0.22, 0.5),
    ("token", UPPER + LOWER + DIGIT + b"+/_=-", 2.6, 0.25, 0.5),
)
_MEMBERS = [classes(members=alphabet) for _, alphabet, *_ in ENCODINGS]
_INDEX = []
for _, _alphabet, *_ in ENCODINGS:
    _INDEX.append(np.zeros(256, np.int64))
    _INDEX[-1][list(_alphabet)] = np.arange(len(_alphabet))
_CLASS = np.full(256, 3, np.int8)
for _k, _letters in enumerate((UPPER, LOWER, DIGIT)):
    _CLASS[list(_letters)] = _k
_VOWEL = classes(members=b"aeiouyAEIOUY")


def _normal(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def battery(token: np.ndarray) -> tuple[int, float]:
    """(encoding, p-value of "made like words") of a token's bytes; trailing ``=`` don't count."""
    n = len(token)
    while n > 1 and token[n - 1] == 61:
        n -= 1
    token = token[:n]
    kind = next(k for k, members in enumerate(_MEMBERS) if members[token].all())
    _, alphabet, excess, switch, tied = ENCODINGS[kind]
    k, index = len(alphabet), _INDEX[kind][token]
    counts = np.bincount(index, minlength=k)
    chi = k / n * float((counts * counts).sum()) - n
    z1 = (chi - (k - 1 + n * excess)) / math.sqrt(2 * (k - 1) + 4 * n * excess)
    group = _VOWEL[token] if kind == 2 else _CLASS[token]
    runs = int((group[1:] != group[:-1]).sum())
    z2 = ((n - 1) * switch - runs) / math.sqrt(max(n - 1, 1) * switch * (1 - switch))
    x = index - index.mean()
    spread = float((x * x).sum())
    r = max(-0.999, min(0.999, float((x[1:] * x[:-1]).sum()) / spread)) if spread else 0.999
    z3 = (math.atanh(r) - math.atanh(tied)) * math.sqrt(max(n - 3, 1))
    if kind == 2:  # words alternate vowels and consonants; here fewer runs and less correlation speak for chance
        z2, z3 = -z2, -z3
    return kind, _normal((z1 + z2 + z3) / math.sqrt(6))


def _stratum(kind: int, length: int) -> int:
    return kind * (len(LENGTHS) + 1) + sum(length >= x for x in LENGTHS)


def _bin(p: float) -> int:
    return min(BINS - 1, int(-math.log10(max(p, 1e-300)) / BIN_WIDTH))


def _candidates(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, start, end, stratum, bin) of every candidate."""
    start, end, _ = words(data, offsets, TOKEN)
    long = np.flatnonzero(end - start >= MIN_TOKEN)
    rows = np.searchsorted(offsets, start[long], "right") - 1
    for row, a, b in zip(rows.tolist(), start[long].tolist(), end[long].tolist(), strict=True):
        kind, p = battery(data[a:b])
        yield row, a - int(offsets[row]), b - int(offsets[row]), _stratum(kind, b - a), _bin(p)


def _histogram(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[int, int], int] = {}
    for part in parts:
        data, offsets = texts_of(part.column("text"))
        for i, j in chunks(offsets):
            for *_, stratum, at in _candidates(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
                counts[stratum, at] = counts.get((stratum, at), 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())], ["stratum", "bin", "n"])


def thresholds(docs: DataFrame, rate: float = 0.01) -> dict[int, int]:
    """For each stratum with discoveries, the lowest bin that counts as one, at a false-discovery rate of ``rate``."""
    rows = docs.select("text").transform(map_batches, _histogram, "stratum int, bin int, n long").groupBy("stratum", "bin").agg(F.sum("n").alias("n")).collect()  # at most strata x bins rows
    out = {}
    for stratum in {r["stratum"] for r in rows}:
        own = sorted(((r["bin"], r["n"]) for r in rows if r["stratum"] == stratum), reverse=True)
        total, seen = sum(n for _, n in own), 0
        for at, n in own:
            seen += n
            if 10 ** (-at * BIN_WIDTH) <= rate * seen / total:
                out[stratum] = at
    return out


def _spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns ``assign`` and ``access``."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found


def _scan(floor: dict[int, int], redact: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, offsets = texts_of(part.column("text"))
            found: list[list[tuple[int, int, int]]] = []
            texts: list[str | None] = []
            for i, j in chunks(offsets):
                own, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                start, end, _ = words(own, at, HEX)
                long = np.flatnonzero(end - start >= 24)
                extra: dict[int, list] = {}
                for row, a, b in zip((np.searchsorted(at, start[long], "right") - 1).tolist(), start[long].tolist(), end[long].tolist(), strict=True):
                    extra.setdefault(row, []).append((a - int(at[row]), 2, b - int(at[row])))
                for row, a, b, stratum, level in _candidates(own, at):
                    if level >= floor.get(stratum, BINS):
                        extra.setdefault(row, []).append((a, 3, b))
                raw = own.tobytes()
                for row in range(j - i):
                    text = raw[at[row] : at[row + 1]]
                    spans = sorted(_spans(text) + extra.get(row, []))
                    if redact:
                        texts.append(_redacted(text, spans).decode())
                    if spans and not text.isascii():
                        chars = np.r_[0, np.cumsum((own[at[row] : at[row + 1]] & 0xC0) != 0x80)]
                        spans = [(int(chars[a]), k, int(chars[b])) for a, k, b in spans]
                    found.append(spans)
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            column = pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in x] for x in found], kinds)
            fixed = [part.column(c) for c in part.schema.names if c != "text"]
            names = [c for c in part.schema.names if c != "text"]
            text = pa.array(texts, pa.string()) if redact else None
            if redact and part.column("text").null_count:
                text = pa.array([t if v else None for t, v in zip(texts, part.column("text").is_valid().to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*fixed, *([text] if redact else []), column], [*names, *(["text"] if redact else []), "secret_spans"])

    return run


def _redacted(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    out, end = [], 0
    for a, k, b in spans:
        if a >= end:
            out += [text[end:a], b"[", KINDS[k].upper().encode(), b"]"]
        end = max(end, b)
    return b"".join(out) + text[end:]


def scan_secrets(docs: DataFrame, rate: float = 0.01, redact: bool = False) -> DataFrame:
    """``docs`` (text, ...) -> the other columns, ``secret_spans`` (kind, start, end in code points, end exclusive, by
    start and kind), and with ``redact`` the text with each run of overlapping spans replaced by its first one's kind.

    Fixed kinds are found leftmost and without overlap within a kind; ``random`` are the battery's discoveries, and
    may cover the same place. Null and empty texts have no spans; null stays null. A column that is already named
    ``secret_spans`` is replaced.
    """
    docs = docs.drop("secret_spans")
    floor = thresholds(docs, rate)
    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["text string"] * redact + ["secret_spans array<struct<kind:string,start:long,end:long>>"])
    return docs.transform(map_batches, _scan(floor, redact), schema)


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secret_spans", lambda x: x["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"))
