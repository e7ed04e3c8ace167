"""Language identification of mixed text: script ranges, word scores, and a Viterbi path with a switching penalty.

Letters belong to script ranges. Per word, the languages seen with its script in training are candidates; each
scores the word by log-probabilities of hashed byte n-grams (1 to 4, with word ends) smoothed over its training text.
A Viterbi path over a text's words, on which a change of language costs ``SWITCH``, gives spans. The prediction is
the language of the most letters on the path; the score is its share of them, weighted by how far its words are
ahead.

Counts are gathered from all training texts and languages: a task holds arrays of ``HELD`` languages and gives them
out when others come; they are summed natively by bucket, so what comes to the driver has at most languages x
(scripts + buckets) rows. A word is scored against its script's candidates only.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, U64, Hasher, chunks, classes, map_batches, texts_of, words

BITS = 16
GRAMS = (1, 2, 3, 4)
SWITCH = 12.0
#: Languages whose counts a task holds at a time. With more languages in the model, texts are labelled in smaller chunks.
HELD = 64
LETTER = classes(members=bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
#: Script ranges by code point: fixed values of the Unicode blocks. Letters elsewhere are of script 0.
SCRIPTS = (
    (0x0041, 0x024F, 1),  # Latin
    (0x1E00, 0x1EFF, 1),
    (0x0370, 0x03FF, 2),  # Greek
    (0x1F00, 0x1FFF, 2),
    (0x0400, 0x052F, 3),  # Cyrillic
    (0x0530, 0x058F, 4),  # Armenian
    (0x0590, 0x05FF, 5),  # Hebrew
    (0x0600, 0x077F, 6),  # Arabic
    (0x08A0, 0x08FF, 6),
    (0x0900, 0x097F, 7),  # Devanagari
    (0x0980, 0x0DFF, 8),  # other scripts of India
    (0x0E00, 0x0E7F, 9),  # Thai
    (0x10A0, 0x10FF, 10),  # Georgian
    (0x1100, 0x11FF, 11),  # Hangul
    (0xAC00, 0xD7AF, 11),
    (0x3040, 0x30FF, 12),  # Kana
    (0x3400, 0x9FFF, 13),  # Han
)
N_SCRIPTS = 14
_STARTS = np.array(sorted(a for a, _, _ in SCRIPTS))
_RANGES = {a: (b, k) for a, b, k in SCRIPTS}
_KINDS = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(0x80, 0x110000)], np.uint8)
#: Code points over U+007F at which runs of characters that are no letters (nor marks on letters) begin and end, in turns.
_SIGNS = np.flatnonzero(np.diff(np.r_[False, (_KINDS != ord("L")) & (_KINDS != ord("M"))])) + 0x80
#: The same for runs of marks, of which no word consists alone.
_MARKS = np.flatnonzero(np.diff(np.r_[False, _KINDS == ord("M")])) + 0x80


def _points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each character that isn't ASCII, its code point)"""
    lead = np.flatnonzero(data >= 0xC0)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
    a, b, c, d = (padded[lead + k] for k in range(4))
    point = np.where(a < 0xE0, (a & 31) << 6 | b & 63, np.where(a < 0xF0, (a & 15) << 12 | (b & 63) << 6 | c & 63, (a & 7) << 18 | (b & 63) << 12 | (c & 63) << 6 | d & 63))
    return lead, point


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    edge: np.ndarray  # row -> range of words
    letters: np.ndarray  # characters per word
    script: np.ndarray
    data: np.ndarray  # lower case, signs blanked


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of letters and marks on them, in lower case; a word has the script of its first letter. Kana count as Han beside Han."""
    data = LOWER[data]
    lead, point = _points(data)
    sign = np.searchsorted(_SIGNS, point, "right") % 2 == 1
    if sign.any():
        at = lead[sign]
        size = np.where(data[at] < 0xE0, 2, np.where(data[at] < 0xF0, 3, 4))
        for k in range(4):
            data[(at + k)[size > k]] = 32
    start, end, edge = words(data, offsets, LETTER)
    follow = np.r_[0, np.cumsum((data & 0xC0) == 0x80)]
    letters = (end - start) - (follow[end] - follow[start])
    marks = np.r_[0, np.cumsum(np.searchsorted(_MARKS, point, "right") % 2)]
    real = letters > marks[np.searchsorted(lead, end)] - marks[np.searchsorted(lead, start)]
    if not real.all():
        start, end, letters, edge = start[real], end[real], letters[real], np.r_[0, np.cumsum(real)][edge]
    script = np.ones(len(start), np.int8)
    first = np.searchsorted(lead, start)
    wide = np.flatnonzero((first < len(lead)) & (lead[np.minimum(first, max(len(lead) - 1, 0))] == start)) if len(lead) else np.zeros(0, np.int64)
    if len(wide):
        p = point[first[wide]]
        slot = _STARTS[np.maximum(np.searchsorted(_STARTS, p, "right") - 1, 0)]
        found = np.array([_RANGES[s] for s in slot.tolist()]).reshape(-1, 2)
        script[wide] = np.where((p >= slot) & (p <= found[:, 0]), found[:, 1], 0)
    return Words(start, end, edge, letters, script, data)


def grams(hasher: Hasher, w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, bucket) for the n-grams of each size, and for each size the one at a word's start, marked as such."""
    prefix = hasher.prefix(w.data)
    size = w.end - w.start
    for k in GRAMS:
        n = np.maximum(size - k + 1, 0)
        word = np.repeat(np.arange(len(size)), n)
        at = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + w.start[word]
        h = hasher.ranges(prefix, at, at + k)
        yield word, (h * U64(2 * k + 1) >> U64(64 - BITS)).astype(np.int64)
        head = np.flatnonzero(n)
        yield head, (hasher.ranges(prefix, w.start[head], w.start[head] + k) * U64(0x9E3779B97F4A7C15 + 2 * k) >> U64(64 - BITS)).astype(np.int64)


def _counts(languages: list[str]):
    place = {x: k for k, x in enumerate(languages)}

    def emit(held: list[int], bucket: np.ndarray, script: np.ndarray) -> Iterator[pa.RecordBatch]:
        for table, kind in ((bucket, 0), (script, 1)):
            k, b = np.nonzero(table)
            language = np.array(held, np.int32)[k]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(language), pa.array(b.astype(np.int32)), pa.array(table[k, b])], ["kind", "language", "bucket", "n"])

    def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros((n, 1 << BITS), np.int64), np.zeros((n, N_SCRIPTS), np.int64)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = Hasher(), []
        bucket, script = tables(0)
        for part in parts:
            lang = np.array([place[x] for x in part.column("lang").to_pylist()], np.int64)
            data, offsets = texts_of(part.column("text"))
            for i, j in chunks(offsets, 1 << 20):
                w = split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                present = np.unique(lang[i:j]).tolist()
                for first in range(0, len(present), HELD):
                    own = present[first : first + HELD]
                    new = [x for x in own if x not in held]
                    if len(held) + len(new) > HELD:
                        yield from emit(held, bucket, script)
                        held, new = [], own
                        bucket, script = tables(0)
                    held = [*held, *new]
                    bucket, script = (np.concatenate([x, y]) for x, y in zip((bucket, script), tables(len(new)), strict=True))
                    slot = np.full(len(languages), -1, np.int64)
                    slot[own] = [held.index(x) for x in own]
                    of = np.repeat(slot[lang[i:j]], np.diff(w.edge))
                    pick = np.flatnonzero(of >= 0)
                    of = of[pick]
                    mine = Words(w.start[pick], w.end[pick], w.edge, w.letters[pick], w.script[pick], w.data)
                    np.add.at(script, (of, mine.script), 1)
                    for word, b in grams(hasher, mine):
                        bucket += np.bincount((of[word] << BITS) + b, minlength=bucket.size).reshape(bucket.shape)
        yield from emit(held, bucket, script)

    return run


@dataclass
class Model:
    languages: list[str]
    score: np.ndarray  # bucket x language, log-probabilities
    candidates: np.ndarray  # script x language


def fit(texts: DataFrame) -> Model:
    """The model of ``texts`` (text, lang): all rows with a language count."""
    texts = texts.where("lang is not null and text is not null").select("text", "lang")
    languages = sorted(r["lang"] for r in texts.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros((N_SCRIPTS, 0), bool))
    table = texts.transform(map_batches, _counts(languages), "kind int, language int, bucket int, n long").groupBy("kind", "language", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most languages x (buckets + scripts) rows
    kind, language, bucket, n = (np.array(table.column(c)) for c in ("kind", "language", "bucket", "n"))
    count = np.zeros((1 << BITS, len(languages)))
    count[bucket[kind == 0], language[kind == 0]] = n[kind == 0]
    script = np.zeros((N_SCRIPTS, len(languages)))
    script[bucket[kind == 1], language[kind == 1]] = n[kind == 1]
    score = np.log((count + 0.1) / (count.sum(axis=0) + 0.1 * (1 << BITS)))
    del count
    # A script narrows to the languages that write a thousandth of their words in it; one that none does, to all.
    candidates = script > 1e-3 * np.maximum(script.sum(axis=0), 1)
    candidates[~candidates.any(axis=1)] = True
    return Model(languages, score - score.mean(axis=1, keepdims=True), candidates)


def word_scores(model: Model, hasher: Hasher, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word x language, which of them each word is); -1e4 is no candidate."""
    key, first, inverse = np.unique(hasher.ranges(hasher.prefix(w.data), w.start, w.end), return_index=True, return_inverse=True)
    total = np.full((len(first), len(model.languages)), -1e4)
    for x in np.unique(w.script[first]).tolist():
        mine = np.flatnonzero(w.script[first] == x)
        at, candidates = first[mine], np.flatnonzero(model.candidates[x])
        own = Words(w.start[at], w.end[at], w.edge, w.letters[at], w.script[at], w.data)
        part, n = np.zeros((len(at), len(candidates))), np.zeros(len(at))
        for word, bucket in grams(hasher, own):
            n += np.bincount(word, minlength=len(at))
            for k, language in enumerate(candidates.tolist()):
                part[:, k] += np.bincount(word, model.score[bucket, language], len(at))
        part *= (np.sqrt(n) / np.maximum(n, 1) * 2)[:, None]  # n-grams of a word overlap; long words shouldn't decide alone
        total[np.ix_(mine, candidates)] = part
    return total, inverse


def paths(score: np.ndarray, edge: np.ndarray, switch: float = SWITCH, word: np.ndarray | None = None) -> np.ndarray:
    """The language of each word on the best path of its row; rows advance together, word by word, longest first.

    ``word``: the row of ``score`` that each word has; by default its own."""
    word = np.arange(len(score)) if word is None else word
    n, k = len(word), score.shape[1]
    out = np.zeros(n, np.int32)
    size = np.diff(edge)
    order = np.argsort(-size, kind="stable")
    begin, size = edge[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    if not longest or k < 2:
        return out
    live = np.searchsorted(-size, -np.arange(longest), "left")  # rows with more than t words
    back = np.zeros((n, -(-k // 8)), np.uint8)  # bits: came from the best language of the word before
    top = np.zeros(n, np.int32)  # that language
    value = score[word[begin[: live[0]]]]
    for t in range(1, longest):
        m = live[t]
        value = value[:m]
        best = value.argmax(axis=1)
        jump = value[np.arange(m), best] - switch
        at = begin[:m] + t
        moved = value < jump[:, None]
        back[at], top[at] = np.packbits(moved, axis=1), best
        value = np.where(moved, jump[:, None], value) + score[word[at]]
        if t + 1 < longest and live[t + 1] < m or t + 1 == longest:
            ends = slice(live[t + 1] if t + 1 < longest else 0, m)
            out[at[ends]] = value[ends].argmax(axis=1)
    single = np.flatnonzero(size == 1)
    out[begin[single]] = score[word[begin[single]]].argmax(axis=1)
    for t in range(longest - 1, 0, -1):
        at = begin[: live[t]] + t
        own = out[at]
        out[at - 1] = np.where(back[at, own >> 3] >> (7 - (own & 7)) & 1, top[at], own)
    return out


SPANS = "array<struct<start:long,end:long,lang:string>>"


def _labelled(model: Model, switch: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, names = Hasher(), np.array([*model.languages, "und"], object)
        for part in parts:
            data, offsets = texts_of(part.column("text"))
            for i, j in chunks(offsets, (1 << 20) * HELD // max(HELD, len(model.languages))):
                raw = data[offsets[i] : offsets[j]]
                w = split(raw, offsets[i : j + 1] - offsets[i])
                rows, k = j - i, len(model.languages)
                if k and len(w.start):
                    score, word = word_scores(model, hasher, w)
                    path = paths(score, w.edge, switch, word).astype(np.int64)
                    of = np.repeat(np.arange(rows), np.diff(w.edge))
                    share = np.bincount(of * k + path, w.letters, rows * k).reshape(rows, k)
                    lead = np.bincount(of * k + path, w.letters, rows * k).reshape(rows, k).sum(axis=1)
                    pick = share.argmax(axis=1)
                    value = share[np.arange(rows), pick] / np.maximum(lead, 1)
                    sums = np.stack([np.bincount(of, np.maximum(score[:, x], -50)[word], rows) for x in range(k)], axis=1)
                    margin = (sums - sums.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(np.diff(w.edge), 1))[:, None]
                    odds = np.exp(np.clip(margin, -50, 0))
                    value = value * (odds[np.arange(rows), pick] / odds.sum(axis=1))
                    none = np.diff(w.edge) == 0
                    pick[none], value[none] = k, 0
                else:
                    of, path = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    pick, value = np.full(rows, k), np.zeros(rows)
                # spans in code points: successive words of a row on one language
                head = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (path[1:] != path[:-1])]) if len(of) else np.zeros(0, np.int64)
                tail = np.r_[head[1:], len(of)][: len(head)] - 1
                follow = np.r_[0, np.cumsum((raw & 0xC0) == 0x80)]
                base = offsets[i:j] - offsets[i]
                chars = lambda at, row: (at - base[row]) - (follow[at] - follow[base[row]])  # noqa: B023, E731
                row = of[head]
                span = pa.StructArray.from_arrays([pa.array(chars(w.start[head], row)), pa.array(chars(w.end[tail], row)), pa.array(names[path[head]], pa.string())], ["start", "end", "lang"])
                spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), span)
                fixed = [part.column(c).slice(i, rows) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(names[pick], pa.string()), pa.array(value), spans], [*part.schema.names, "lang_pred", "score", "lang_spans"])

    return run


def label(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``docs`` (text, ...) with lang_pred (``und`` for null, empty and letterless texts), score in [0, 1] and
    lang_spans (start, end in code points, lang). Columns that already have one of these names are replaced; other
    columns and repeated rows stay. A model without languages labels all ``und``."""
    docs = docs.drop("lang_pred", "score", "lang_spans")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.transform(map_batches, _labelled(model, switch), ", ".join([*fields, "lang_pred string", "score double", f"lang_spans {SPANS}"]))


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Learns from documents that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = fit(docs.where(~held).select("text", "lang"))
    found = label(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
