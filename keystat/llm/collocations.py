"""Phrase collocations: Rabin-Karp fingerprints of all n-grams, checked against the text.

Texts are cut at punctuation and line ends into pieces, these into words. A prefix polynomial over
the words' hashes gives every n-gram's fingerprint by one subtraction; the language is
part of it. Fingerprints are counted per task, then by a shuffle, and since a phrase is as
rare as its rarest part, lengths go in steps: words, then pairs of frequent words, then the longer
phrases all of whose pairs are frequent. What is frequent is told to the next step by a
bitmap of ``FILTER_BITS`` bits, of the same size for any corpus; a wrong bit costs a count, no phrase.

Fingerprints only choose what is looked at. The last pass cuts the n-grams whose fingerprints are
frequent from the text: the occurrences of a fingerprint are compared, word by word and byte by byte, with
the first one, those that differ form groups of their own, and each group is given with its text, count
and pointer (the least document that holds it). Sums by text are exact, whatever collided.

A phrase's association is ``floor(1000 a n / (l r))``, the least over its cuts, in
exact decimals; phrases that a longer one explains are left out.

Defined results: a null text is empty, the null language is ``und``; a text of no words counts nothing;
repeated rows count each time; ties rank by count, then by the phrase's UTF-8 bytes; an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystat.llm.common import LOWER, byte_table, materialise, mix, ship_package, text_runs, word_hashes, words

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
COVERED = 100  # percent of a phrase's occurrences that lie in one longer phrase
FILTER_BITS = 1 << 26
#: Fingerprints, and phrases with their texts, that a task gathers before it counts them; bytes
#: of text handled at once.
GATHERED = 1 << 21
GATHERED_PHRASES = 1 << 19
RUN_BYTES = 1 << 21
#: Hot languages are dealt to so many tasks where rows meet by language alone.
SALTS = 64

# What separates pieces, and what separates words in them.
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
UNKNOWN = "und"

_IS_SEPARATOR = byte_table(lambda b: b in SEPARATORS)
_IS_WORD = byte_table(lambda b: b not in SEPARATORS + BLANKS)
_BASE = 0xD1342543DE82EF95 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class _Run:
    """The words of a run of texts and the fingerprints of their n-grams."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray) -> None:
        self.data = LOWER[data]
        self.starts, self.ends, first = words(self.data, offsets, _IS_WORD)
        self.first = first
        n = len(self.starts)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        # words that go on with the next one: in one text, no separator between
        separators = np.zeros(len(data) + 1, np.int32)
        np.cumsum(_IS_SEPARATOR[self.data], out=separators[1:])
        self.goes_on = np.zeros(n, bool)
        if n:
            self.goes_on[:-1] = (self.text[1:] == self.text[:-1]) & (
                separators[self.starts[1:]] == separators[self.ends[:-1]])
        self.seeds = seeds
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        with np.errstate(over="ignore"):
            self.prefix = np.zeros(n + 1, np.uint64)
            np.cumsum(self.hashes * _powers(_BASE, n), out=self.prefix[1:])
            self.undo = _powers(_UNBASE, n)

    def fingerprints(self, places: np.ndarray, n: int) -> np.ndarray:
        """Of the ``n`` words from each place."""
        with np.errstate(over="ignore"):
            value = (self.prefix[places + n] - self.prefix[places]) * self.undo[places]
            return mix(value ^ self.seeds[self.text[places]] ^ (np.uint64(n) << np.uint64(56)))


def _has(bitmap: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
    bit = fingerprints & np.uint64(FILTER_BITS - 1)
    return (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0


def _step(run: _Run, step: int, known: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, fingerprints) of the n-grams of a step: 1 words, 2 pairs of known words,
    3 longer phrases of known pairs."""
    places = np.arange(len(run.starts))
    if step == 1:
        yield 1, places, run.fingerprints(places, 1)
        return
    pairs = places[run.goes_on]
    if step == 2:
        word = _has(known, run.fingerprints(places, 1))
        pairs = pairs[word[pairs] & word[pairs + 1]]
        yield 2, pairs, run.fingerprints(pairs, 2)
        return
    pair = np.zeros(len(places) + 1, bool)
    pair[pairs] = _has(known, run.fingerprints(pairs, 2))
    left = pair[:-1].copy()
    for n in range(3, LONGEST + 1):
        left[:max(0, len(left) - n + 2)] &= pair[n - 2:len(left)]
        left[max(0, len(left) - n + 2):] = False
        at = np.flatnonzero(left)
        yield n, at, run.fingerprints(at, n)


def _seeds(langs: list[str]) -> np.ndarray:
    seen: dict[str, int] = {}
    for lang in langs:
        if lang not in seen:
            seen[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    return np.array([seen[lang] for lang in langs], np.uint64)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], _Run]]:
    langs = batch.column("lang").to_pylist()
    for row, data, offsets in text_runs(batch.column("text"), RUN_BYTES):
        own = langs[row:row + len(offsets) - 1]
        yield row, own, _Run(data, offsets, _seeds(own))


def _count_batches(batches: Iterator[pa.RecordBatch], step: int, known) -> Iterator[pa.RecordBatch]:
    bitmap = known.value if known is not None else None  # of the step before
    gathered: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(gathered), return_counts=True)
        gathered.clear()
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["fp", "count"])

    for batch in batches:
        for _, _, run in _runs(batch):
            gathered += [fp for _, _, fp in _step(run, step, bitmap)]
            if sum(map(len, gathered)) >= GATHERED:
                yield counted()
    if gathered:
        yield counted()


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of ranges, one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _same_bytes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words ``a`` and ``b`` have the same bytes, pair by pair."""
    same = sizes[a] == sizes[b]
    some = np.flatnonzero(same)
    if len(some):
        size = sizes[a[some]]
        equal = data[_spread(starts[a[some]], size)] == data[_spread(starts[b[some]], size)]
        same[some] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
    return same


def _groups(keys: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each row the first row that has its key and is the same by ``same``."""
    leader = np.empty(len(keys), np.int64)
    left = np.argsort(keys, kind="stable")
    while len(left):
        new = np.ones(len(left), bool)
        new[1:] = keys[left[1:]] != keys[left[:-1]]
        head = left[np.flatnonzero(new)[np.cumsum(new) - 1]]
        equal = same(left, head)
        leader[left[equal]] = head[equal]
        left = left[~equal]
    return leader


def _phrases_of(run: _Run, langs: list[str], ranks: np.ndarray, bitmaps: tuple) -> Iterator[list]:
    """Columns (lang, n, phrase, count, least rank of a document) of a run's phrases, by length."""
    frequent, known_words, known_pairs = bitmaps
    lang_names, lang_of = np.unique(langs, return_inverse=True)
    names = pa.array(lang_names.tolist(), pa.string())
    sizes = run.ends - run.starts
    word = _groups(run.hashes, lambda a, b: _same_bytes(run.data, run.starts, sizes, a, b))
    # the run's words with one blank after each: any phrase is a range of it
    text_starts = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes + 1, out=text_starts[1:])
    joined = np.full(text_starts[-1], 0x20, np.uint8)
    joined[_spread(text_starts[:-1], sizes)] = run.data[_spread(run.starts, sizes)]
    totals = np.bincount(lang_of, np.diff(run.first), len(names)).astype(np.int64)
    yield [names, np.zeros(len(names), np.int32), pa.array([""] * len(names)), totals, np.zeros(len(names), np.int64)]
    for step, known in ((1, None), (2, known_words), (3, known_pairs)):
        for n, places, fingerprints in _step(run, step, known):
            hit = _has(frequent, fingerprints)
            places, fingerprints = places[hit], fingerprints[hit]
            if not len(places):
                continue
            text = run.text[places]

            def same(a, b, n=n, places=places, text=text):
                equal = lang_of[text[a]] == lang_of[text[b]]
                for j in range(n):
                    equal &= word[places[a] + j] == word[places[b] + j]
                return equal

            group = _groups(fingerprints, same)
            order = np.argsort(group, kind="stable")
            heads = np.flatnonzero(np.diff(group[order], prepend=-1))
            first = group[order][heads]
            begin, size = text_starts[places[first]], text_starts[places[first] + n] - 1 - text_starts[places[first]]
            offsets = np.zeros(len(first) + 1, np.int32)
            np.cumsum(size, out=offsets[1:])
            phrases = pa.StringArray.from_buffers(
                len(first), pa.py_buffer(offsets), pa.py_buffer(joined[_spread(begin, size)]))
            yield [names.take(pa.array(lang_of[text[first]])), np.full(len(first), n, np.int32), phrases,
                   np.diff(heads, append=len(order)), np.minimum.reduceat(ranks[text[order]], heads)]


def _phrase_batches(batches: Iterator[pa.RecordBatch], bitmaps) -> Iterator[pa.RecordBatch]:
    """(lang, n, phrase, count, doc_id) of the n-grams with frequent fingerprints, by their texts, added up
    within the task; a row of n = 0 for each language holds its number of words."""
    names = ["lang", "n_words", "phrase", "count", "doc_id"]
    gathered: list[pa.Table] = []
    pending = 0  # rows since the last addition

    def add() -> int:
        found = pa.concat_tables(gathered).group_by(names[:3], use_threads=False).aggregate(
            [("count", "sum"), ("doc_id", "min")]).rename_columns(names)
        gathered[:] = [found.combine_chunks()]
        return len(found)

    for batch in batches:
        ids = batch.column("doc_id")
        by_rank = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        rank = np.empty(len(ids), np.int64)
        rank[by_rank] = np.arange(len(ids))
        for row, langs, run in _runs(batch):
            for lang, n, phrase, count, least in _phrases_of(run, langs, rank[row:row + len(langs)], bitmaps.value):
                pointer = ids.take(pa.array(by_rank[least]))
                gathered.append(pa.table([lang, pa.array(n), phrase, pa.array(count), pointer], names=names))
                pending += len(n)
            if pending >= GATHERED_PHRASES:
                pending = 0
                if add() >= GATHERED_PHRASES:
                    yield from gathered.pop().to_batches()
    if gathered:
        add()
        yield from gathered.pop().to_batches()


def _bitmap(fingerprints: DataFrame) -> np.ndarray:
    """The filter of a step's frequent fingerprints: at most ``FILTER_BITS / 64`` rows reach the driver."""
    bit = F.col("fp").bitwiseAND(F.lit(FILTER_BITS - 1))
    found = (fingerprints.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(F.lit(63)).cast("int").alias("b"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toArrow())
    bitmap = np.zeros(FILTER_BITS // 64, np.uint64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bitmap


def phrase_counts(docs: DataFrame, *, key: str = "doc_id", min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, n_words, phrase, count, pointer) of all words and phrases of up to ``LONGEST`` words with at least
    ``min_count`` occurrences in a language, and a row of 0 words and the language's number of words.
    ``pointer`` is the least doc_id of a document in which it occurs."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"), "text")
    broadcast = spark.sparkContext.broadcast
    frequent, bitmaps = None, []
    for step in (1, 2, 3):
        known = bitmaps[-1] if bitmaps else None
        counted = texts.select("lang", "text").mapInArrow(
            lambda batches, step=step, known=known: _count_batches(batches, step, known), "fp long, count long")
        found = materialise(counted.groupBy("fp").agg(F.sum("count").alias("count"))
                            .where(F.col("count") >= min_count).select("fp"), "frequent")
        bitmaps.append(broadcast(_bitmap(found)))
        frequent = found if frequent is None else frequent.unionByName(found)
    every = broadcast((_bitmap(frequent), bitmaps[0].value, bitmaps[1].value))
    id_type = docs.schema[key].dataType.simpleString()
    phrases = texts.mapInArrow(lambda batches: _phrase_batches(batches, every),
                               f"lang string, n_words int, phrase string, count long, doc_id {id_type}")
    return (phrases.groupBy("lang", "n_words", "phrase")
            .agg(F.sum("count").alias("count"), F.min("doc_id").alias("pointer"))
            .where((F.col("count") >= min_count) | (F.col("n_words") == 0)))


def association(a: Column, left: Column, right: Column, n: Column) -> Column:
    """``floor(1000 a n / (l r))`` of whole numbers, exact while products have at most 38 digits
    (an overflow is an error, not a wrong number)."""
    a, left, right, n = (c.cast("decimal(38,0)") for c in (a, left, right, n))
    return F.call_function("div", F.lit(1000).cast("decimal(38,0)") * a * n, left * right)


def _joined(words_: Column) -> Column:
    return F.array_join(words_, " ")


def _least_cut(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases (lang, phrase, a, n, words) with the counts of the parts of their worst cut, and its score."""
    cuts = phrases.select("lang", "phrase", "a", "n", "words",
                          F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": _joined(F.slice("words", 1, F.col("k"))),
                             "rest": _joined(F.slice("words", F.col("k") + 1, LONGEST))})
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("count").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", association(F.col("a"), F.col("l"), F.col("r"), F.col("n")))
    return (scored.groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))


def _not_covered(phrases: DataFrame, covered: int) -> DataFrame:
    """The phrases without those whose words lie in a longer one that holds ``covered`` percent of them."""
    size = F.size("words")
    parts = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: _joined(F.slice("words", i, m)))))
    inside = (phrases.where(size > 2).select("lang", F.explode(F.array_distinct(parts)).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    return phrases.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, *, key: str = "doc_id", min_count: int = MIN_COUNT, top: int | None = TOP,
                 covered: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, pointer): each language's ``top`` phrases (all, if None)."""
    counts = materialise(phrase_counts(docs, key=key, min_count=min_count), "phrases")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    totals = counts.where("n_words = 0").select(
        "lang", F.col("count").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    long = counts.where("n_words > 1").withColumn("salt", salt)
    phrases = materialise(long.join(totals, ["lang", "salt"]).select(
        "lang", "phrase", F.col("count").alias("a"), "n", F.split("phrase", " ").alias("words"), "pointer"), "candidates")
    kept = _not_covered(phrases.select("lang", "phrase", "a", "n", "words"), covered)
    scored = _least_cut(kept, counts.where("n_words > 0")).join(
        phrases.select("lang", "phrase", "pointer"), ["lang", "phrase"]).withColumn("salt", salt)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # a hot language's best are chosen among its shares' best
        scored = (scored.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
                  .where(F.col("place") <= top))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "pointer")
