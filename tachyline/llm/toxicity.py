"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

Features are hashed words and word beginnings (4, 6 and 8 bytes, so inflected forms share weights), as occurrences
per 100 words. One weight vector serves all thresholds: P(grade <= k) = sigmoid(cut_k - w.x) with ascending cuts.
The model is fitted on at most ``SAMPLE`` labelled documents; which features it uses is decided by a chi-squared
score over the same documents. Every document is scored in whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, U64, Hasher, chunks, classes, map_batches, materialize, texts_of, words

#: Labelled documents that a model is fitted on, at most; those whose identifiers have the smallest hashes.
SAMPLE = 8000
#: Features kept, at most.
FEATURES = 4096
BITS = 18
LENGTHS = (4, 6, 8, 0)  # bytes of a word's beginning; 0 is the word
LETTER = classes(members=bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
GRADES = 3


def features(hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each of ``LENGTHS`` (row, feature) of all words, and each row's number of words."""
    data = LOWER[data]
    start, end, edge = words(data, offsets, LETTER)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(edge))
    prefix, out = hasher.prefix(data), []
    for k, length in enumerate(LENGTHS):
        long = np.flatnonzero(end - start > length) if length else np.arange(len(start))
        stop = start[long] + length if length else end
        h = hasher.ranges(prefix, start[long], stop) * U64(2 * k + 1)
        out.append((row[long], (h >> U64(64 - BITS)).astype(np.int64)))
    return out, np.diff(edge)


@dataclass
class Model:
    weights: np.ndarray  # by feature
    cuts: np.ndarray  # ascending

    def scores(self, hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found, n = features(hasher, data, offsets)
        total = np.zeros(len(n))
        for row, feature in found:
            total += np.bincount(row, self.weights[feature], len(n))
        return 100 * total / (n + 20)

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and cut."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -500, 500)))


def grades(labels: DataFrame) -> DataFrame:
    """labels (doc_id, toxic, quality) -> doc_id, grade: 0 clean, 1 toxic in a text of quality, 2 toxic in a poor one."""
    grade = F.when(F.col("toxic") > 0, F.when(F.coalesce("quality", F.lit(1)) > 0, 1).otherwise(2)).otherwise(0)
    return labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(grade).alias("grade"))


def _sampled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for part in parts:
        grade = part.column("grade")
        data, offsets = texts_of(part.column("text"))
        for i, j in chunks(offsets):
            found, n = features(hasher, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            key = np.concatenate([row * (1 << BITS) + feature for row, feature in found])
            key, count = np.unique(key, return_counts=True)
            row, feature = key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)
            edge = np.searchsorted(row, np.arange(j - i + 1))
            lists = lambda x, t: pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(x, t))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([grade.slice(i, j - i), pa.array(n), lists(feature, pa.int32()), lists(count, pa.int32())], ["grade", "n_words", "features", "counts"])


def _fit(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grade: np.ndarray, width: int, penalty: float = 2e-4, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of the cumulative-link model by accelerated gradient descent on the mean log loss."""
    n, cuts_n = len(grade), GRADES - 1
    tail = np.array([(grade > k).mean() for k in range(cuts_n)])
    tail = np.clip(tail, 1e-4, 1 - 1e-4)
    cuts = np.log((1 - tail) / tail)
    cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(cuts_n))
    w, m, v, cm, cv = np.zeros(width), np.zeros(width), np.zeros(width), np.zeros(cuts_n), np.zeros(cuts_n)
    edges = lambda s, c: 1 / (1 + np.exp(np.clip(s[:, None] - c[None, :], -500, 500)))
    at = np.arange(n)
    for step in range(1, steps + 1):
        score = np.bincount(rows, w[columns] * values, n)
        below = np.c_[np.zeros(n), edges(score, cuts), np.ones(n)]  # P(grade <= k), k = -1 ..
        high, low = below[at, grade + 1], below[at, grade]
        p = np.maximum(high - low, 1e-9)
        slope_high, slope_low = high * (1 - high) / p, low * (1 - low) / p
        by_score = (slope_high - slope_low) / n
        g = np.bincount(columns, by_score[rows] * values, width) + penalty * w
        cg = np.array([(slope_low[grade == k + 1].sum() - slope_high[grade == k].sum()) / n for k in range(cuts_n)])
        for x, grad, a, b, rate in ((w, g, m, v, 0.05), (cuts, cg, cm, cv, 0.05)):
            a *= 0.9
            a += 0.1 * grad
            b *= 0.99
            b += 0.01 * grad * grad
            x -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        cuts[:] = np.maximum.accumulate(np.r_[cuts[0], np.maximum(cuts[1:], cuts[:-1] + 1e-3)])
    return w, cuts


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, keep: int = FEATURES) -> Model:
    """The model for ``labels`` (doc_id, grade in 0..2) of ``docs`` (doc_id, text). Without two grades it finds nothing toxic.

    Of rows that share a doc_id the smallest text counts, so ``sample`` bounds what is gathered."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("grade").alias("grade"), F.min("text").alias("text"))  # one row for a doc_id
    rows = materialize(own.select("grade", "text").transform(map_batches, _sampled, "grade int, n_words long, features array<int>, counts array<int>"), "sampled")  # the sample is bounded
    n, toxic = rows.agg(F.count("*"), F.count_if(F.col("grade") > 0)).first()
    nothing = Model(np.zeros(1 << BITS), np.array([50.0, 51.0]))
    if not toxic or toxic == n:
        return nothing
    seen = rows.select(F.explode("features").alias("feature"), (F.col("grade") > 0).cast("int").alias("hit")).groupBy("feature").agg(F.count("*").alias("df"), F.sum("hit").alias("hits"))
    expected = F.col("df") * (toxic / n)
    chi = (F.col("hits") - expected) * (F.col("hits") - expected) / (expected * (1 - F.col("df") / (n + 1.0)) + 0.5)
    chosen = [r["feature"] for r in seen.where("df >= 3").orderBy(chi.desc(), "feature").limit(keep).collect()]
    place = {f: k for k, f in enumerate(chosen)}

    def pick(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for grade, words_, f, c in zip(*(part.column(k).to_pylist() for k in ("grade", "n_words", "features", "counts")), strict=True):
                own = [(place[x], y) for x, y in zip(f, c, strict=True) if x in place]
                out.append((grade, words_, [x for x, _ in own], [y for _, y in own]))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())), strict=True)], ["grade", "n_words", "features", "counts"])

    table = rows.transform(map_batches, pick, rows.schema).orderBy("grade", "n_words", "features").toArrow()  # at most ``sample`` rows
    lengths = np.array([len(x) for x in table.column("features").to_pylist()])
    column = np.concatenate([np.array(x, np.int64) for x in table.column("features").to_pylist()])
    count = np.concatenate([np.array(x, np.float64) for x in table.column("counts").to_pylist()])
    row = np.repeat(np.arange(len(lengths)), lengths)
    value = 100 * count / (np.array(table.column("n_words"))[row] + 20)
    w, cuts = _fit(row, column, value, np.array(table.column("grade")).astype(np.int64), len(chosen))
    weights = np.zeros(1 << BITS)
    weights[chosen] = w
    return Model(weights, cuts)


def _scored(model: Model, threshold: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for part in parts:
            data, offsets = texts_of(part.column("text"))
            above = np.concatenate([model.above(model.scores(hasher, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) for i, j in chunks(offsets)] or [np.zeros((0, GRADES - 1))])
            grade = (above > 0.5).sum(axis=1)
            names = part.schema.names
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(above.sum(axis=1)), pa.array(grade.astype(np.int32)), pa.array(above[:, 0] >= threshold)], [*names, "severity", "grade", "toxic"])

    return run


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` (text, ...) with ``severity`` (expected grade, 0 to 2), ``grade`` and ``toxic`` (P(grade > 0) >= threshold).

    Null and empty texts, and texts without letters, get what the cuts alone give. Columns that already have one
    of these names are replaced; rows stay as they are, repeated ones too.
    """
    docs = docs.drop("severity", "grade", "toxic")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.transform(map_batches, _scored(model, threshold), f"{schema}, severity double, grade int, toxic boolean")


def op9_toxicity_severity(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, severity, grade, toxic."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_toxicity(docs.select("doc_id", "text"), fit(docs, grades(labels))).drop("text")
