"""SentencePiece encoding and decoding with a batched Viterbi search.

A text is cut into units at white space and around characters that no longer piece contains, so that no piece
spans a cut. Distinct units of a batch are encoded once. Units of equal length advance together: hashes of all
their substrings are probed in the sorted keys of the pieces, and a maximum per position over piece lengths, taken
for all units at once, leaves the back-pointers that are then followed from the ends.

Models of type unigram keep their own scores, and get the identifiers that the public library gives. A BPE model
has merge ranks in place of scores, whose sums mean nothing; its pieces are scored by a Zipf law of their rank.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Hasher, chunks, map_batches, texts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁".encode()
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
#: Distinct units that a task keeps encoded.
CACHE = 200_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass
class Vocabulary:
    pieces: list[bytes]  # by identifier; of a byte piece the byte itself, of control pieces nothing
    keys: np.ndarray  # sorted hashes of the pieces that may match
    ids: np.ndarray  # by key
    scores: np.ndarray  # by key
    longest: int
    unknown: int
    unknown_score: float
    byte_ids: np.ndarray | None
    dummy_prefix: bool
    lonely: np.ndarray  # bytes under 128 that are in no piece of two bytes or more

    @classmethod
    def load(cls, path: str, zipf: bool | None = None) -> Vocabulary:
        """Of a ``.model`` file. ``zipf``: score by rank; by default if the model isn't of type unigram."""
        with open(path, "rb") as f:
            return cls.parse(f.read(), zipf)

    @classmethod
    def parse(cls, model: bytes, zipf: bool | None = None) -> Vocabulary:
        rows, kind, prefix = [], 1, True
        for number, value in _fields(model):
            if number == 1:
                own = dict(_fields(value))
                rows.append((own.get(1, b""), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif number == 2:
                kind = dict(_fields(value)).get(3, 1)
            elif number == 3:
                own = dict(_fields(value))
                prefix = bool(own.get(3, 1))
                if own.get(2) or own.get(4, 1):
                    raise ValueError("only models that keep the text as it is (identity, all white space) are supported")
        zipf = kind != 1 if zipf is None else zipf
        hasher, match = Hasher(), [k for k, r in enumerate(rows) if r[2] in (NORMAL, USER_DEFINED)]
        if zipf:
            score = {k: -round(math.log(n + 2.7) * 256) / 256 for n, k in enumerate(match)}
        else:
            score = {k: rows[k][1] for k in match}
        data = np.frombuffer(b"".join(rows[k][0] for k in match), np.uint8)
        edge = np.cumsum([0, *(len(rows[k][0]) for k in match)])
        keys = hasher.ranges(hasher.prefix(data), edge[:-1], edge[1:])
        order = np.argsort(keys)
        byte_ids = np.full(256, -1, np.int32)
        texts = []
        for k, (piece, _, type_) in enumerate(rows):
            if type_ == BYTE:
                byte_ids[int(piece[3:5], 16)] = k
                texts.append(bytes([int(piece[3:5], 16)]))
            else:
                texts.append(piece if type_ in (NORMAL, USER_DEFINED) else " ⁇ ".encode() if type_ == UNKNOWN else b"")
        lonely = np.zeros(256, bool)
        lonely[:128] = True
        for k in match:
            if len(rows[k][0]) > 1:
                lonely[list(rows[k][0])] = False
        return cls(texts, keys[order], np.array(match, np.int32)[order], np.array([score[k] for k in match])[order], max(len(rows[k][0]) for k in match), next((k for k, r in enumerate(rows) if r[2] == UNKNOWN), 0), min(score.values()) - 10, byte_ids if (byte_ids >= 0).all() else None, prefix, lonely)


def _viterbi(vocabulary: Vocabulary, hasher: Hasher, data: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of identifiers, identifiers one after another) of the units of ``length`` bytes at ``start``."""
    n, v = len(start), vocabulary
    reach = min(v.longest, length)
    prefix = hasher.prefix(data)
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, length + 1), np.int32)  # bytes of the last piece
    found = np.full((n, length + 1), -1, np.int32)  # its identifier
    heads = (data[start[:, None] + np.arange(length)] & 0xC0) != 0x80
    step = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
    for end in range(1, length + 1):
        low = max(0, end - reach)
        begin = np.arange(low, end)  # the longest piece first; it stays on ties
        at = start[:, None] + begin
        live = heads[:, low:end] if end == length else heads[:, low:end] & heads[:, end : end + 1]
        rows, columns = np.nonzero(live & (best[:, low:end] > -np.inf))
        key = hasher.ranges(prefix, at[rows, columns], start[rows] + end)
        slot = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        hit = v.keys[slot] == key
        value = np.full((n, len(begin)), -np.inf)
        name = np.full((n, len(begin)), -1, np.int32)
        r, c = rows[hit], columns[hit]
        value[r, c] = best[r, low + c] + v.scores[slot[hit]]
        name[r, c] = v.ids[slot[hit]]
        r, c = rows[~hit], columns[~hit]
        single = step[at[r, c]] == end - begin[c]
        r, c = r[single], c[single]
        value[r, c] = best[r, low + c] + v.unknown_score
        pick = value.argmax(axis=1)
        every = np.arange(n)
        best[:, end], found[:, end], back[:, end] = value[every, pick], name[every, pick], end - begin[pick]
    # Follow the back-pointers of all units at once.
    where, steps = np.full(n, length), []
    rows = np.arange(n)
    while len(rows):
        pos = where[rows]
        steps.append((rows, pos, found[rows, pos], back[rows, pos]))
        where[rows] = pos - back[rows, pos]
        rows = rows[where[rows] > 0]
    row, pos, name, size = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.lexsort((pos, row))
    row, pos, name, size = row[order], pos[order], name[order], size[order]
    if (unknown := name < 0).any():
        if v.byte_ids is None:
            name[unknown] = v.unknown
        else:
            spread = np.where(unknown, size, 1)
            index = np.repeat(np.arange(len(name)), spread)
            inner = np.arange(len(index)) - np.repeat(np.cumsum(spread) - spread, spread)
            bytes_ = data[start[row[index]] + pos[index] - size[index] + inner]
            name, row = np.where(unknown[index], v.byte_ids[bytes_], name[index]), row[index]
    return np.bincount(row, minlength=n), name


class Encoder:
    """Encodes batches of texts; keeps the identifiers of units seen before."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.hasher = vocabulary, Hasher()
        self._clear()

    def _clear(self) -> None:
        self.known, self.at, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, ends, units per text)"""
        lead = b" " if self.v.dummy_prefix else b""
        texts = [(lead + t).replace(b" ", SPACE) if t else b"" for t in texts]
        offsets = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data)
        if not n:
            return data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        space = np.zeros(n + 3, bool)
        space[: n - 2] = (data[:-2] == SPACE[0]) & (data[1:-1] == SPACE[1]) & (data[2:] == SPACE[2])
        cut = np.zeros(n + 1, bool)
        cut[:n] = space[:n]
        cut[3:n] &= ~space[: n - 3]  # a run of spaces belongs to what follows
        alone = np.flatnonzero(self.v.lonely[data])
        cut[alone] = cut[alone + 1] = True
        cut[offsets[:-1]] = True
        cut[n] = True
        edge = np.flatnonzero(cut)
        return data, edge[:-1], edge[1:], np.diff(np.searchsorted(edge, offsets))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers of all texts one after another, number per text)"""
        data, start, end, per_text = self._units(texts)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        key, first, inverse = np.unique(self.hasher.ranges(self.hasher.prefix(data), start, end), return_index=True, return_inverse=True)
        if len(self.known) > CACHE:
            self._clear()
        slot = np.searchsorted(self.known, key)
        fresh = np.flatnonzero(self.known[np.minimum(slot, len(self.known) - 1)] != key) if len(self.known) else np.arange(len(key))
        if len(fresh):
            a, size = start[first[fresh]], end[first[fresh]] - start[first[fresh]]
            order = np.argsort(size, kind="stable")
            parts_key, parts_count, parts_id = [self.known], [self.count], [self.ids]
            groups = np.split(order, np.flatnonzero(np.diff(size[order])) + 1)
            for own in groups:
                length = int(size[own[0]])
                for piece in np.array_split(own, min(len(own), -(-len(own) * length // 400_000))):
                    pick = a[piece][:, None] + np.arange(length)
                    block = data[pick].ravel()
                    count, ids = _viterbi(self.v, self.hasher, block, np.arange(len(piece)) * length, length)
                    parts_key.append(key[fresh[piece]])
                    parts_count.append(count)
                    parts_id.append(ids)
            known, count = np.concatenate(parts_key), np.concatenate(parts_count)
            # ``ids`` only grows; ``at`` says where each unit's identifiers are
            begin = np.concatenate([self.at, len(self.ids) + np.cumsum(np.r_[0, count[len(self.known) :]])[:-1]])
            order = np.argsort(known, kind="stable")
            self.known, self.count, self.at, self.ids = known[order], count[order], begin[order], np.concatenate(parts_id)
            slot = np.searchsorted(self.known, key)
        unit = slot[inverse]
        count = self.count[unit]
        total = np.cumsum(count)
        index = np.arange(total[-1]) - np.repeat(total - count, count) + np.repeat(self.at[unit], count)
        edge = np.r_[0, total][np.r_[0, np.cumsum(per_text)]]
        return self.ids[index], np.diff(edge)


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.size = np.array([len(p) for p in vocabulary.pieces], np.int64)
        self.at = np.cumsum(np.r_[0, self.size])[:-1]
        self.data = np.frombuffer(b"".join(vocabulary.pieces), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text."""
        size = self.size[ids]
        total = np.cumsum(size) if len(ids) else np.zeros(0, np.int64)
        index = np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size) + np.repeat(self.at[ids], size)
        data = self.data[index].tobytes()
        edge = np.r_[0, total][np.r_[0, np.cumsum(counts)]]
        out = [data[a:b].replace(SPACE, b" ") for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        return [t[1:] if self.v.dummy_prefix and t[:1] == b" " else t for t in out]


def _encoded(vocabulary: Vocabulary, digests: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for part in parts:
            data, offsets = texts_of(part.column("text"))
            keep = [k for k in part.schema.names if k != "text"]
            for i, j in chunks(offsets, 1 << 20):
                texts = [data[offsets[k] : offsets[k + 1]].tobytes() for k in range(i, j)]
                ids, counts = encoder.encode(texts)
                edge = np.r_[0, np.cumsum(counts)]
                fixed = [part.column(k).slice(i, j - i) for k in keep]
                n = pa.array(counts.astype(np.int64))
                if digests:
                    raw = ids.astype("<i4").tobytes()
                    back = decoder.decode(ids, counts)
                    hashes = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*fixed, n, pa.array(hashes, pa.string()), pa.array([x == y for x, y in zip(texts, back, strict=True)], pa.bool_())], [*keep, "n_tokens", "ids_sha256", "round_trip"])
                else:
                    yield pa.RecordBatch.from_arrays([*fixed, n, pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids))], [*keep, "n_tokens", "token_ids"])

    return run


def encode(docs: DataFrame, model: str = MODEL, digests: bool = False, zipf: bool | None = None) -> DataFrame:
    """``docs`` (text, ...) -> the other columns, n_tokens and token_ids; with ``digests``, in place of token_ids,
    ids_sha256 (of the identifiers as 32-bit integers, little end first) and round_trip (decoding gives the text).

    Null and empty texts have no tokens. Texts with the character U+2581 decode with spaces in its place, as the
    format has it. Columns that already have one of these names are replaced; other columns and repeated rows stay.
    """
    docs = docs.drop("n_tokens", "token_ids", "ids_sha256", "round_trip")
    vocabulary = Vocabulary.load(model, zipf)
    fixed = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text"]
    return docs.transform(map_batches, _encoded(vocabulary, digests), ", ".join([*fixed, "n_tokens long", *(["ids_sha256 string", "round_trip boolean"] if digests else ["token_ids array<int>"])]))


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """``tokens`` (token_ids, ...) -> the other columns and text. Null identifiers give null, none give an empty text."""
    vocabulary = Vocabulary.load(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for part in parts:
            lists = part.column("token_ids")
            ids = [np.array(x, np.int64) if x is not None else np.zeros(0, np.int64) for x in lists.to_pylist()]
            texts = decoder.decode(np.concatenate(ids or [np.zeros(0, np.int64)]), np.array([len(x) for x in ids], np.int64))
            keep = [k for k in part.schema.names if k != "token_ids"]
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array([t.decode("utf-8", "replace") if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist(), strict=True)], pa.string())], [*keep, "text"])

    tokens = tokens.drop("text")
    fixed = [f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields if f.name != "token_ids"]
    return tokens.transform(map_batches, run, ", ".join([*fixed, "text string"]))


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, round_trip."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), digests=True)
