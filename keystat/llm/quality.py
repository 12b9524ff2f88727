"""Quality classifier: random-indexing word vectors and a small neural network.

Terms are a text's words and their shapes (letter case, signs at the ends, length,
whether the word before is the same), hashed to ``ROWS`` rows. Random indexing gives each
document a sparse random vector of +1 and -1; a term's vector is the sum of those of the documents it
occurs in, over the whole corpus, so terms that share documents get similar
vectors. A document is the mean of its terms' vectors, words and shapes apart.

A two-layer network in numpy (tanh, then logistic) is fitted on those features of
at most ``SAMPLE`` labelled rows, those of the smallest hashes of id and label, and then of id,
label and text where ids repeat; a fifth is held back to find the temperature of its
probabilities (1 where there are fewer than ``LEAST_HELD`` rows). Everything else covers all rows.

Rows are kept one for one. An empty or null text has a zero vector and is scored
like any other; without labelled rows every score is 0.5. Repeated rows, long
texts and extra columns need no care; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.llm.common import SPACED_WORD, byte_table, mix, text_runs, word_hashes, words

WORD_ROWS, SHAPE_ROWS = 1 << 14, 1 << 11
ROWS = WORD_ROWS + SHAPE_ROWS
DIMENSIONS = 48
#: Places of a document's random vector that are not 0.
NONZERO = 4
#: The table of vectors is summed in so many slices; each first in up to ``PARTS`` parts.
SLICES = 48
PARTS = 8
SAMPLE = 4000
#: Samples of fewer rows are too small to hold a fifth back.
LEAST_HELD = 50
HIDDEN = 24
EPOCHS = 60
RATE = 0.1

_UPPER = byte_table(lambda b: 65 <= b <= 90)
_LETTER = byte_table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_DIGIT = byte_table(lambda b: 48 <= b <= 57)


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[ends] - total[starts]


def terms(data: np.ndarray, offsets: np.ndarray):
    """(rows of the words, rows of their shapes, first words of the texts)."""
    starts, ends, first = words(data, offsets, SPACED_WORD)
    h = word_hashes(data, starts, ends)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), first
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    same[first[:-1][first[:-1] < len(h)]] = False
    upper, letters = _sums(_UPPER[data], starts, ends), _sums(_LETTER[data], starts, ends)
    digits, n = _sums(_DIGIT[data], starts, ends), ends - starts
    last = data[ends - 1]
    signs = np.where(_LETTER[last] | _DIGIT[last], 0, last)
    shape = np.stack([np.minimum(upper, 3), np.minimum(n - letters - digits, 4), np.minimum(digits, 2),
                      np.minimum(n, 12) // 3, signs, same]).astype(np.uint64)
    code = np.zeros(len(h), np.uint64)
    with np.errstate(over="ignore"):
        for part in shape:
            code = mix(code * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(1))
    return ((h >> np.uint64(50)).astype(np.int64), (WORD_ROWS + (code >> np.uint64(53))).astype(np.int64), first)


def _random_vectors(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the sparse random vectors of 64-bit keys."""
    with np.errstate(over="ignore"):
        draws = mix(keys[:, None] + np.arange(1, NONZERO + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    return (draws % np.uint64(DIMENSIONS)).astype(np.int64), 1.0 - 2.0 * (draws >> np.uint64(63)).astype(np.float64)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of the terms' vectors, in slices of the table."""
    table = np.zeros(ROWS * DIMENSIONS)
    any_row = False
    for batch in batches:
        for _, data, offsets in text_runs(batch.column("text")):
            word, shape, first = terms(data, offsets)
            any_row |= len(word) > 0
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            # a text's key is the sum of its words' hashes: equal texts get equal vectors
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(word.astype(np.uint64)))])
            with np.errstate(over="ignore"):
                keys = mix(total[first[1:]] - total[first[:-1]])
            places, signs = _random_vectors(keys)
            for rows in (word, shape):
                for k in range(NONZERO):
                    table += np.bincount(rows * DIMENSIONS + places[text, k], signs[text, k], ROWS * DIMENSIONS)
    if any_row:
        parts = np.array_split(table.reshape(ROWS, DIMENSIONS), SLICES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([p.astype(np.float32).tobytes() for p in parts], pa.binary())],
            names=["slice", "sums"])


def _add(kind: type):
    """Sums of each slice's rows, which come as numbers of ``kind`` and leave as doubles."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column("slice").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                values = np.frombuffer(sums, kind).astype(np.float64)
                totals[part] = totals[part] + values if part in totals else values
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array([v.tobytes() for v in totals.values()], pa.binary())],
                names=["slice", "sums"])

    return add


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of term vectors, over all texts, each of length 1 (or 0)."""
    schema = "slice int, sums binary"
    tables = docs.select("text").mapInArrow(_index, schema).withColumn(
        "part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    # a task's table is 3.5 MB: with many tasks, a slice's sums are too much for one reducer
    first = tables.repartition("slice", "part").select("slice", "sums").mapInArrow(_add(np.float32), schema)
    parts = first.repartition("slice").mapInArrow(_add(np.float64), schema).collect()
    table = np.zeros((ROWS, DIMENSIONS))
    if parts:
        found = {r["slice"]: np.frombuffer(r["sums"]) for r in parts}
        table = np.concatenate([found[i] for i in range(SLICES)]).reshape(ROWS, DIMENSIONS)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(norm > 0, norm, 1)).astype(np.float32)


def _pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Features of every text: mean word vector, mean shape vector, log of the word count."""
    out = np.zeros((len(column), 2 * DIMENSIONS + 1), np.float32)
    for row, data, offsets in text_runs(column):
        word, shape, first = terms(data, offsets)
        n = np.diff(first)
        some = np.flatnonzero(n > 0)
        if len(some):
            for j, rows in enumerate((word, shape)):
                sums = np.add.reduceat(vectors[rows], first[:-1][some], axis=0)
                out[row + some, j * DIMENSIONS:(j + 1) * DIMENSIONS] = sums / n[some, None]
        out[row:row + len(n), -1] = np.log1p(n) / 10
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    first: tuple[np.ndarray, np.ndarray]
    second: tuple[np.ndarray, float]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.spread @ self.first[0] + self.first[1])
        return hidden @ self.second[0] + self.second[1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray) -> QualityModel | None:
    """Momentum descent in batches on four fifths; the rest sets the temperature."""
    if not len(y):
        return None
    held = np.arange(len(y)) % 5 == 0 if len(y) >= LEAST_HELD else np.zeros(len(y), bool)
    xt, yt = x[~held].astype(np.float64), y[~held].astype(np.float64)
    rng = np.random.default_rng(5)
    mean, spread = xt.mean(axis=0), xt.std(axis=0) + 1e-3
    z = (xt - mean) / spread
    weights = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    speed = [np.zeros_like(w) for w in weights]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(yt))
        for a in range(0, len(yt), 32):
            rows = order[a:a + 32]
            hidden = np.tanh(z[rows] @ weights[0] + weights[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3][0], -40, 40)))
            g = (p - yt[rows]) / len(rows)
            back = np.outer(g, weights[2]) * (1 - hidden ** 2)
            grads = [z[rows].T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ g + 1e-4 * weights[2],
                     np.array([g.sum()])]
            for k in range(4):
                speed[k] = 0.9 * speed[k] - rate * 0.1 * grads[k]
                weights[k] = weights[k] + speed[k]
    model = QualityModel(mean, spread, (weights[0], weights[1]), (weights[2], float(weights[3][0])))
    if held.any():
        logit, truth = model.logits(x[held]), y[held]
        doubt = 1 / (len(truth) + 2)
        target = np.where(truth == 1, 1 - doubt, doubt)

        def loss(t: float) -> float:
            return float(np.mean(np.logaddexp(0, logit / t) - target * logit / t))

        model.temperature = min((float(t) for t in np.geomspace(0.2, 10, 80)), key=loss)
    return model


def _features(shared):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _pooled(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array([r.tobytes() for r in x], pa.binary())], names=["quality", "x"])

    return features


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, *, sample: int = SAMPLE) -> QualityModel | None:
    """Fit on at most ``sample`` texts with labels, of at most so many rows of ``labels`` (doc_id, quality)."""
    spark = docs.sparkSession
    drawn = (labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality").distinct()
             .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample))
    shared = spark.sparkContext.broadcast(vectors)
    # an id may have many rows: the bound holds for the rows that meet a label
    met = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = (met.orderBy(F.xxhash64("doc_id", "quality", "text")).limit(sample).select("text", "quality")
            .mapInArrow(_features(shared), "quality int, x binary").collect())
    rows = sorted((r["x"], r["quality"]) for r in rows)
    np.random.default_rng(3).shuffle(rows)
    x = np.array([np.frombuffer(r[0], np.float32) for r in rows]).reshape(len(rows), 2 * DIMENSIONS + 1)
    return fit(x, np.array([int(r[1]) for r in rows]))


def _scores(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, model = shared.value
        for batch in batches:
            x = _pooled(batch.column("__text"), vectors)
            values = model.scores(x) if model is not None else np.full(len(x), 0.5)
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(values, pa.float64())],
                names=[*[batch.schema.names[i] for i in keep], "score"])

    return score


def score_quality(docs: DataFrame, vectors: np.ndarray, model: QualityModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1 (a column of that name is replaced)."""
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast((vectors, model))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema)
    return docs.withColumn("__text", F.col(text)).mapInArrow(_scores(shared), schema + "score double")
