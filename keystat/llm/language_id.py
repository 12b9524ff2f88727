"""Language identification by averaged hashed subword embeddings.

A text is lower-cased and cut into words of letters; the character n-grams
(``GRAMS`` long) of the words with their edges are hashed to ``BUCKETS`` embedding
rows. The mean of a text's rows goes through a linear softmax. Embeddings and
softmax are trained together by stochastic gradient descent in numpy.

Only the fit uses a sample: the ``SAMPLE`` labelled rows, at most, with the smallest hashes of id,
text and language; rows without an id or of one id are drawn like others. A fifth of it is held
back to calibrate: a temperature for the probabilities, and
the rejection threshold, below which fall at most ``REJECT`` of the held-back rows
that were named rightly. Fewer than ``LEAST_HELD`` rows are all learned from: the temperature
is 1 then and nothing with letters is rejected. Prediction reads whole texts. As the softmax is linear, a bucket's
embedding times the weights is one row of class scores, so predicting sums those.

Rows are kept one for one. A null text or one without letters is ``und`` with
score 0; without any labelled row everything is. Nulls in other columns, long
texts, repeated rows and extra columns need no care; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystat.llm.common import hand_back, handing_back, mix, ship_package

GRAMS = (2, 3)
BUCKETS = 1 << 13
DIMENSIONS = 16
SAMPLE = 3000
EPOCHS = 12
RATE = 0.5
REJECT = 0.001
#: Samples of fewer rows are too small to hold a fifth back.
LEAST_HELD = 50
#: Of the rows held back, so many are scored at once.
HELD_ROWS = 64
UNDETERMINED = "und"
#: Characters that are handled at once, about.
RUN_CHARS = 1 << 18


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _runs(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, lower-cased texts) by about ``RUN_CHARS`` characters."""
    first, texts, n = 0, [], 0
    for i, value in enumerate(column):
        text = (value.as_py() or "").lower()
        if texts and n + len(text) > RUN_CHARS:
            yield first, texts
            first, texts, n = i, [], 0
        texts.append(text)
        n += len(text)
    if texts:
        yield first, texts


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams, their texts); n-grams never cross a word's edge."""
    codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0)
    lengths = np.array([len(t) + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), lengths)
    # one edge between words, and one before the first
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes, text = np.concatenate([[0], codes[keep]]).astype(np.uint64), np.concatenate([[0], text[keep]])
    edge = codes == 0
    found, owners = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            m = len(codes) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            good = np.ones(m, bool)
            for j in range(n):
                h = h * np.uint64(0x100000001B3) + codes[j:j + m]
                if 0 < j < n - 1:
                    good &= ~edge[j:j + m]
            if n == 2:
                good &= ~(edge[:m] & edge[1:])
            found.append((mix(h[good]) >> np.uint64(64 - 13)).astype(np.int64))
            owners.append(text[1:1 + m][good])  # an n-gram's second code is never an edge before its word
    return np.concatenate(found), np.concatenate(owners)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # class scores of every bucket
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        logits = (sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


Bag = tuple[str, np.ndarray, np.ndarray]  # language, buckets, counts


def _shares(bags: list[Bag], rows: np.ndarray) -> np.ndarray:
    """The rows' bucket shares, one column a bucket. Made for a few rows at a time: for a whole sample they
    would take the driver 100 MB."""
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, row in enumerate(rows.tolist()):
        _, buckets, counts = bags[row]
        x[i, buckets] = counts / counts.sum()
    return x


def _train(bags: list[Bag], y: np.ndarray, own: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Class scores of the buckets, and the bias, from the ``own`` rows of the sample."""
    rng = np.random.default_rng(7)
    emb = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, classes), np.float32)
    bias = np.zeros(classes, np.float32)
    weight = len(own) / (classes * np.maximum(np.bincount(y[own], minlength=classes), 1))
    scale = np.float32(BUCKETS ** 0.5)  # shares are small: their embeddings learn faster
    batch, steps, step = 16, EPOCHS * max(1, -(-len(own) // 16)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(own)
        for a in range(0, len(own), batch):
            rows = order[a:a + batch]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            xb = _shares(bags, rows)
            hidden = xb @ emb
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (weight[y[rows]] / len(rows))[:, None].astype(np.float32)
            back = p @ out.T
            out -= rate * scale * (hidden.T @ p)
            bias -= rate * p.sum(axis=0)
            emb -= rate * scale * (xb.T @ back)
    return emb @ out, bias


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least negative log-likelihood, on a grid. Targets
    are smoothed by one doubtful row in all, so that rows without an error don't
    make the model infinitely sure."""
    doubt = 1 / (len(y) + 2)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        own = (1 - doubt) * z[np.arange(len(y)), y] + doubt * z.mean(axis=1)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - own))

    return min((float(t) for t in np.geomspace(0.05, 5, 60)), key=loss) if len(y) else 1.0


def fit(sample: list[Bag]) -> LanguageModel | None:
    """A model from (language, buckets, counts) rows; None without any."""
    sample = [s for s in sample if len(s[1])]
    languages = sorted({s[0] for s in sample})
    if not languages:
        return None
    y = np.array([languages.index(s[0]) for s in sample])
    held = np.arange(len(y)) % 5 == 0 if len(y) >= LEAST_HELD else np.zeros(len(y), bool)
    table, bias = _train(sample, y, np.flatnonzero(~held), len(languages))
    tests = np.flatnonzero(held)
    sums = np.zeros((len(tests), len(languages)), np.float32)
    for a in range(0, len(tests), HELD_ROWS):
        sums[a:a + HELD_ROWS] = _shares(sample, tests[a:a + HELD_ROWS]) @ table
    model = LanguageModel(languages, table.astype(np.float32), bias, calibrate(sums + bias, y[held]), 0.0)
    if held.any():
        p = model.probabilities(sums, np.ones(held.sum()))
        right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y[held]])
        if len(right):
            model.threshold = float(min(0.5, right[int(REJECT * len(right))]))
    return model


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in handing_back(batches):
        for row, texts in _runs(batch.column("text")):
            buckets, owner = subwords(texts)
            ids, counts = [], []
            order = np.argsort(owner, kind="stable")
            for part in np.split(buckets[order], np.searchsorted(owner[order], np.arange(1, len(texts)))):
                b, c = np.unique(part, return_counts=True)
                ids.append(b)
                counts.append(c)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(row, len(texts)),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["lang", "buckets", "counts"])


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text (null: empty), modulo ``n``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def train(docs: DataFrame, *, sample: int = SAMPLE) -> LanguageModel | None:
    """Fit on the ``sample`` rows, at most, of (doc_id, text, lang) that have a language and a text and
    the smallest hashes of all three."""
    ship_package(docs.sparkSession)
    key = F.xxhash64(F.col("doc_id").cast("string"), "text", "lang")
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # the bound is found on hashes alone; texts of the rows below it are read after, and rows with
    # the hash at the bound are copies of one another, of which the limit leaves some
    least = labelled.select(key.alias("key")).orderBy("key").limit(sample).agg(F.max("key")).first()[0]
    if least is None:
        return None
    drawn = labelled.where(key <= least).orderBy(key).limit(sample)
    bags = drawn.select("lang", "text").mapInArrow(
        _bags, "lang string, buckets array<int>, counts array<int>").toArrow().combine_chunks()
    if not len(bags):
        return None
    cut = lambda c: np.split(c.values.to_numpy(), c.offsets.to_numpy()[1:-1])
    buckets, counts = (cut(bags.column(c).chunk(0)) for c in ("buckets", "counts"))
    rows = list(zip(bags.column("lang").to_pylist(), buckets, counts, strict=True))
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))  # any order of tasks gives one model
    return fit([rows[i] for i in np.random.default_rng(11).permutation(len(rows)).tolist()])


def _predict(shared, text: pa.Array) -> pa.Array:
    """(lang_pred, score, accepted) of each text."""
    model: LanguageModel | None = shared.value
    names, scores, accepted = [], [], []
    for _, texts in _runs(text):
        if model is None:
            names += [UNDETERMINED] * len(texts)
            scores += [0.0] * len(texts)
            accepted += [False] * len(texts)
            continue
        buckets, owner = subwords(texts)
        n = np.bincount(owner, minlength=len(texts))
        sums = np.stack([np.bincount(owner, model.table[buckets, c], len(texts))
                         for c in range(len(model.languages))], axis=1)
        p = model.probabilities(sums, n)
        best = p.argmax(axis=1)
        top = np.where(n > 0, p.max(axis=1), 0.0)
        names += [model.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), n.tolist(), strict=True)]
        scores += top.tolist()
        accepted += ((top >= model.threshold) & (n > 0)).tolist()
    return pa.StructArray.from_arrays(
        [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
        names=["lang_pred", "score", "accepted"])


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (calibrated probability) and
    ``accepted`` (not rejected). Input columns of these names are replaced."""
    ship_package(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "accepted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # only the text goes to Python and three small values come back; the other columns stay.
    # (said to be nondeterministic: else a filter on its results would compute them again)
    @F.arrow_udf("lang_pred string, score double, accepted boolean")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            yield _predict(shared, text)
        hand_back()

    found = docs.withColumn("__found", predict.asNondeterministic()(F.col(text)))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], "__found.*")
