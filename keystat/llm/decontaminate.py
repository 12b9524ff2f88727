"""Benchmark decontamination by suffix arrays of the training documents.

Texts are lower-cased (A-Z) and cut into words. Each shard of documents
(some batches of a task) sorts the suffixes of its word sequences into a suffix array,
and every suffix of the benchmark items is looked up in it by binary search.
That gives every place where at least ``WINDOW`` words (or a whole shorter item)
occur verbatim; neighbouring hits are then merged into the longest matches, with
their places in the document and in the item.

A suffix that can't start a window is left out of the array: one of its first
words, up to the shortest window, is in no item. Suffixes are ordered by their
first ``WINDOW`` words, which is as far as the search compares. Words are
compared by 64-bit hashes, so two different sequences of ten words count as one
with a chance of about 2^-64 per word.

The benchmark is read in blocks of ``BLOCK_BYTES`` of text, chosen by a hash of the
rows; one block at a time goes to the tasks, and the documents are passed over
once for each, so nothing that grows with either table is broadcast whole. A
null text has no words; an item without words has no windows; a null item id
counts as an empty string; repeated items count once; documents are kept one
for one; with an empty benchmark nothing is hit. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.llm.common import (LETTER_WORD, LOWER, hand_back, materialise, ship_package, text_runs, word_hashes,
                                words)

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: A shard's suffix array covers about so many bytes of rows.
SHARD_BYTES = 16 << 20

MATCH = "struct<item:string,doc_start:int,item_start:int,n_words:int>"


@dataclass
class Suffixes:
    """A block of the benchmark: its vocabulary and the windows its suffixes start with."""

    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place plus 1
    keys: dict[int, np.ndarray]  # by window length: the windows as byte strings that sort alike
    item: dict[int, np.ndarray]
    start: dict[int, np.ndarray]
    names: list[str]

    @property
    def shortest(self) -> int:
        return min(self.keys, default=0)


def _word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of all words, first word of each row) by runs."""
    for row, data, offsets in text_runs(column):
        data = LOWER[data]
        starts, ends, first = words(data, offsets, LETTER_WORD)
        yield row, word_hashes(data, starts, ends), first


def _numbers(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the words, 0 for those that are not in the vocabulary."""
    if not len(vocabulary):
        return np.zeros(len(hashes), np.uint32)
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)


def _keys(numbers: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` words from each start as one byte string (big-endian, so
    that byte order is the words' order)."""
    if not len(starts):
        return np.zeros(0, f"S{4 * width}")
    rows = numbers[starts[:, None] + np.arange(width)].astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * width}").ravel()


def read_suffixes(items: pa.Table) -> Suffixes:
    items = items.combine_chunks()
    hashes, names, lengths = [], [], []
    for row, h, first in _word_hashes(items.column("text")):
        hashes.append(h)
        lengths += np.diff(first).tolist()
    names = [x or "" for x in items.column("item").to_pylist()]
    whole = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    vocabulary = np.unique(whole)
    numbers, at = _numbers(vocabulary, whole), 0
    places: dict[int, list[tuple[int, int, int]]] = {}
    for i, n in enumerate(lengths):
        if n:
            w = min(WINDOW, n)
            places.setdefault(w, []).extend((i, j, at + j) for j in range(n - w + 1))
        at += n
    cut = {w: np.array(p) for w, p in places.items()}
    return Suffixes(vocabulary, {w: _keys(numbers, p[:, 2], w) for w, p in cut.items()},
                    {w: p[:, 0] for w, p in cut.items()}, {w: p[:, 1] for w, p in cut.items()}, names)


def _suffix_array(column: pa.Array, block: Suffixes):
    """(words of each row, row, place and sorted keys of the suffixes)."""
    n_words = np.zeros(len(column), np.int64)
    rows, places, keys = [], [], []
    m = block.shortest
    for row, h, first in _word_hashes(column):
        n_words[row:row + len(first) - 1] = np.diff(first)
        numbers = np.concatenate([_numbers(block.vocabulary, h), np.zeros(WINDOW, np.uint32)])
        # a text's last words are followed by the next text's: the array's keys stop there
        known = np.concatenate([[0], np.cumsum(numbers > 0)])
        at = np.arange(len(h))
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        left = first[1:][text] - at
        can = np.flatnonzero((known[at + m] - known[at] == m) & (left >= m)) if m else at[:0]
        if not len(can):
            continue
        cut = numbers[can[:, None] + np.arange(WINDOW)]
        cut[np.arange(WINDOW) >= left[can][:, None]] = 0
        rows.append(row + text[can])
        places.append(can - first[text[can]])
        keys.append(np.ascontiguousarray(cut.astype(">u4")).view(f"S{4 * WINDOW}").ravel())
    if not rows:
        return n_words, np.zeros(0, int), np.zeros(0, int), np.zeros(0, f"S{4 * WINDOW}")
    rows, places, keys = np.concatenate(rows), np.concatenate(places), np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    return n_words, rows[order], places[order], keys[order]


def _matches(rows, places, keys, block: Suffixes):
    """Longest matches (row, item, doc start, item start, words), by looking every
    benchmark suffix up in the array."""
    found = []
    for w, wanted in block.keys.items():
        prefix = keys.astype(f"S{4 * w}")
        low, high = np.searchsorted(prefix, wanted, "left"), np.searchsorted(prefix, wanted, "right")
        n = high - low
        which = np.repeat(np.arange(len(wanted)), n)
        at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if not len(at):
            continue
        row, place, item, start = rows[at], places[at], block.item[w][which], block.start[w][which]
        # hits of one item on one diagonal at consecutive places are one match
        order = np.lexsort((place, place - start, item, row))
        row, place, item, start = row[order], place[order], item[order], start[order]
        diagonal = place - start
        new = np.ones(len(row), bool)
        new[1:] = ((row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1])
                   | (place[1:] != place[:-1] + 1))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        found.append(np.stack([row[first], item[first], place[first], start[first],
                               place[last] - place[first] + w]))
    return np.concatenate(found, axis=1) if found else np.zeros((5, 0), np.int64)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined until they hold ``SHARD_BYTES``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= SHARD_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _pass(block, everything: bool):
    """Look a block up in all documents; without ``everything``, keep those with matches."""
    match_type = pa.list_(pa.struct([("item", pa.string()), ("doc_start", pa.int32()),
                                     ("item_start", pa.int32()), ("n_words", pa.int32())]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes: Suffixes = block.value
        names = np.array(suffixes.names, object)
        for batch in _shards(batches):
            n_words, rows, places, keys = _suffix_array(batch.column("__text"), suffixes)
            row, item, start, item_start, n = _matches(rows, places, keys, suffixes)
            order = np.argsort(row, kind="stable")
            offsets = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            matches = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(names[item[order]] if len(row) else [], pa.string())]
                + [pa.array(x[order], pa.int32()) for x in (start, item_start, n)], fields=list(match_type.value_type)))
            keep = [i for i, name in enumerate(batch.schema.names) if name != "__text"]
            out = pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(n_words, pa.int64()), matches],
                names=[*[batch.schema.names[i] for i in keep], "n_words", "matches"])
            yield out if everything else out.filter(pa.array(np.diff(offsets) > 0))

    return look_up


def _items(benchmark: DataFrame, text: str, item: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The distinct items (item, text), and the number of blocks that they are read in."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    return items, int(size // block_bytes) + 1


def _block(items: DataFrame, blocks: int, b: int):
    """Block ``b`` of the items, broadcast."""
    part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
    return items.sparkSession.sparkContext.broadcast(read_suffixes(part.toArrow()))


def find_matches(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``matches`` (longest verbatim matches: item,
    doc_start, item_start, n_words, in words), ``n_hit`` (words inside any match)
    and ``items`` (their distinct item ids, sorted). Input columns of these names
    are replaced; the text column stays."""
    ship_package(docs.sparkSession)
    docs = docs.drop(*[c for c in ("n_words", "matches", "n_hit", "items") if c != text])
    items, blocks = _items(benchmark, text, item, block_bytes)
    whole = docs.withColumn("__text", F.col(text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema = (schema + ", " if schema else "") + f"n_words long, matches array<{MATCH}>"

    def one(b: int, frame: DataFrame, everything: bool) -> DataFrame:
        return frame.mapInArrow(_pass(_block(items, blocks, b), everything), schema)

    if blocks == 1:
        found = one(0, whole, True)
    else:
        # rows are numbered, so that each block's matches meet their document again
        numbered = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
        slim = numbered.select("__row", F.col(text).alias("__text"))
        parts = []
        schema = f"__row long, n_words long, matches array<{MATCH}>"
        for b in range(blocks):
            parts.append(materialise(one(b, slim, b == 0), "matches"))
        together = parts[0]
        for p in parts[1:]:
            together = together.unionByName(p)
        together = together.groupBy("__row").agg(F.max("n_words").alias("n_words"),
                                                 F.flatten(F.collect_list("matches")).alias("matches"))
        found = numbered.join(together, "__row").drop("__row")
    ranges = F.array_sort(F.transform("matches", lambda m: F.struct(
        m["doc_start"].alias("start"), (m["doc_start"] + m["n_words"]).alias("end"))))
    hit = F.aggregate(
        ranges, F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(acc["at"], x["start"]))).alias("n")),
        lambda acc: acc["n"].cast("long"))
    return found.withColumns({
        "n_hit": hit, "items": F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))})


def _held(column: pa.Array, block: Suffixes) -> np.ndarray:
    """Whether each text holds a window: each distinct window is looked up once, whatever items share it."""
    _, rows, _, keys = _suffix_array(column, block)
    hit = np.zeros(len(column), bool)
    for w, wanted in block.keys.items():
        prefix, wanted = keys.astype(f"S{4 * w}"), np.unique(wanted)
        low, high = np.searchsorted(prefix, wanted, "left"), np.searchsorted(prefix, wanted, "right")
        # places of the array that lie in some window's range
        edge = np.zeros(len(rows) + 1, np.int64)
        np.add.at(edge, low, 1)
        np.add.at(edge, high, -1)
        hit[rows[np.cumsum(edge[:-1]) > 0]] = True
    return hit


def _holds(block):
    # only texts go to Python, shard by shard, and a flag for each comes back
    @F.arrow_udf("boolean")
    def holds(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held: list[pa.Array] = []
        for text in texts:
            held.append(text)
            if sum(t.nbytes for t in held) >= SHARD_BYTES:
                yield pa.array(_held(pa.concat_arrays(held), block.value))
                held = []
        if held:
            yield pa.array(_held(pa.concat_arrays(held), block.value))
        hand_back()

    return holds.asNondeterministic()


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without those that hold a window of an item. Every column but the text stays in the
    JVM; with several blocks, what one leaves is written before the next goes over it."""
    ship_package(docs.sparkSession)
    items, blocks = _items(benchmark, text, item, block_bytes)
    for b in range(blocks):
        found = docs.withColumn("__held", _holds(_block(items, blocks, b))(F.col(text)))
        left = found.where(~F.col("__held")).select(*[F.col(f"`{c}`") for c in docs.columns])
        docs = materialise(left, "clean") if b + 1 < blocks else left
    return docs
