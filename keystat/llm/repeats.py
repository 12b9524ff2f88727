"""Substring deduplication: recurring passages by Aho-Corasick automata.

A window is ``WINDOW`` consecutive words; a word is removed if a window that covers it
starts anywhere else too, in the same text or another.

1. Every window names the least hash among its phrases of ``PHRASE`` words. Equal
   windows name equal phrases, so a window can recur only if its phrase was named
   at two places: phrases are counted over all documents, and the others drop out.
2. For each place of a recurring phrase, the windows that name it form a segment
   (their words, as 32-bit word hashes). Segments go to shards by phrase.
3. A shard confirms which windows occur twice, joins neighbouring ones into
   recurring passages, compiles them into an Aho-Corasick automaton and streams its
   segments through it; every occurrence found is a range of words to remove.

Every window lies in one segment, so nothing is missed. Phrases named more than
``HOT`` times take no shard: their windows are counted by hash, with partial sums
before the shuffle, and joined back to their places, which Spark splits where one is frequent.
Two different windows would be taken as equal if they differ only in words whose
32-bit hashes are equal, a chance of 2^-32 for each pair that differs in one word.

Null texts have no words; rows are kept one for one, and repeated rows are each
other's repetition; null ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.llm.common import (SPACED_WORD, gram_hashes, group_rows, materialise, mix, text_runs,
                                word_hashes, words)

WINDOW = 35
PHRASE = 10
HOT = 20_000
#: Segments that a shard's automaton is compiled from, about; groups are kept whole.
SHARD_SEGMENTS = 50_000


def _least_at(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the (first) least of each ``width`` consecutive values."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


def _named(data: np.ndarray, offsets: np.ndarray):
    """(word hashes, first words, segments): a segment is (text, phrase, first and
    last window, both as word numbers), for windows that name the same place."""
    starts, ends, first = words(data, offsets, SPACED_WORD)
    h = word_hashes(data, starts, ends)
    window, text = group_rows(first, WINDOW)
    if not len(window):
        none = np.zeros(0, np.int64)
        return h, first, none, np.zeros(0, np.uint64), none, none
    grams = gram_hashes(h, PHRASE)
    place = _least_at(grams, WINDOW - PHRASE + 1)[window]
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(window)) - 1
    return h, first, text[begin], grams[place[begin]], window[begin], window[end]


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in text_runs(batch.column("text")):
            _, first, text, phrase, _, _ = _named(data, offsets)
            n = len(offsets) - 1
            raw, cut = data.tobytes(), offsets.tolist()
            whole = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest()
                     for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).slice(row, n) for c in ("doc_id", "id", "check")],
                 pa.array(np.diff(first), pa.int64()), pa.array(whole, pa.string()),
                 pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()),
                                          pa.array(phrase.view(np.int64)))],
                names=["doc_id", "id", "check", "n_words", "whole_sha256", "phrases"])


def _recurring(batches: Iterator[pa.RecordBatch], hot: bool):
    """(batch, hashes, words, first words, and the segments' rows, texts, phrases, first and last
    windows) of the recurring phrases that are hot, or aren't."""
    for batch in batches:
        for row, data, offsets in text_runs(batch.column("text")):
            h, first, text, phrase, begin, end = _named(data, offsets)
            n = len(offsets) - 1
            own = batch.column("recurring").slice(row, n)
            owner = np.repeat(np.arange(n), pc.list_value_length(own).to_numpy(zero_copy_only=False))
            known = own.flatten()
            known_phrase = known.field("phrase").to_numpy(zero_copy_only=False).view(np.uint64)
            hot_phrase = known.field("hot").to_numpy(zero_copy_only=False)
            # both sides as one hash of (text, phrase), looked up by sorting
            with np.errstate(over="ignore"):
                place = lambda t, p: mix(p + t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                wanted = place(owner, known_phrase)
                order = np.argsort(wanted)
                wanted, hot_phrase = wanted[order], hot_phrase[order]
                mine = place(text, phrase)
            at = np.minimum(np.searchsorted(wanted, mine), max(0, len(wanted) - 1))
            hit = (wanted[at] == mine) if len(wanted) else np.zeros(len(mine), bool)
            hit &= (hot_phrase[at] == hot) if len(wanted) else False
            if hit.any():
                yield batch, h, first, row + text[hit], text[hit], phrase[hit], begin[hit], end[hit]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments (shard, id, check, start, words) of the phrases that aren't hot."""
    for batch, h, first, rows, text, phrase, begin, end in _recurring(batches, False):
        small = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
        rows = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(phrase.view(np.int64)), batch.column("id").take(rows), batch.column("check").take(rows),
             pa.array(begin - first[text], pa.int32()),
             pa.array([small[4 * x:4 * y] for x, y in zip(begin.tolist(), (end + WINDOW).tolist(), strict=True)],
                      pa.binary())],
            names=["shard", "id", "check", "start", "words"])


def _hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, id, check, start) of every window of a hot phrase."""
    for batch, h, first, rows, text, _, begin, end in _recurring(batches, True):
        times = end - begin + 1
        which = np.repeat(np.arange(len(text)), times)
        at = begin[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        owner = pa.array(rows[which])
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram_hashes(h, WINDOW)[at].view(np.int64)), batch.column("id").take(owner),
             batch.column("check").take(owner), pa.array(at - first[text[which]], pa.int32())],
            names=["window", "id", "check", "start"])


def _locate(segments: pa.Table) -> pa.RecordBatch:
    """Confirm a shard's recurring windows, compile their passages, and stream the
    segments through the automaton: ranges (id, check, start, end)."""
    import ahocorasick

    texts = segments.column("words").to_pylist()
    lengths = np.array([len(t) // 4 for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    numbers = np.frombuffer(b"".join(texts), np.uint32)
    window, text = group_rows(first, WINDOW)
    hashes = gram_hashes(mix(numbers.astype(np.uint64)), WINDOW)[window]
    _, which, count = np.unique(hashes, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[which] > 1)
    # runs of neighbouring recurring windows are passages
    new = np.ones(len(again), bool)
    new[1:] = (window[again][1:] != window[again][:-1] + 1) | (text[again][1:] != text[again][:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(again)) - 1 if len(again) else begin
    passages = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for a, b in zip(window[again[begin]].tolist(), window[again[end]].tolist(), strict=True):
        passage = numbers[a:b + WINDOW]
        if passages.setdefault(passage.tobytes(), len(passages)) == len(passages) - 1:
            automaton.add_word(tuple(passage.tolist()), len(passage))
    rows, starts, ends = [], [], []
    if passages:
        automaton.make_automaton()
        for i in np.unique(text[again]).tolist():
            left = right = -1
            for last, length in automaton.iter(tuple(numbers[first[i]:first[i + 1]].tolist())):
                if left < 0 or last + 1 - length > right:
                    if left >= 0:
                        rows.append(i), starts.append(left), ends.append(right)
                    left = last + 1 - length
                left, right = min(left, last + 1 - length), last + 1
            if left >= 0:
                rows.append(i), starts.append(left), ends.append(right)
    at = pa.array(rows, pa.int64())
    offset = segments.column("start").to_numpy()[rows] if rows else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays(
        [segments.column("id").take(at).combine_chunks(), segments.column("check").take(at).combine_chunks(),
         pa.array(offset + np.array(starts, np.int32), pa.int32()),
         pa.array(offset + np.array(ends, np.int32), pa.int32())], names=["id", "check", "start", "end"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the sorted segments into shards of whole groups, and locate in each."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= SHARD_SEGMENTS:
            table = pa.Table.from_batches(held)
            shard = table.column("shard").to_numpy()
            whole = int(np.searchsorted(shard, shard[-1]))  # the last group may go on
            if whole:
                yield _locate(table.slice(0, whole).combine_chunks())
                held, n = table.slice(whole).combine_chunks().to_batches(), n - whole
    if held:
        yield _locate(pa.Table.from_batches(held).combine_chunks())


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, kept = [], []
        for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
            found = (text.as_py() or "").encode().split()
            stay = np.ones(len(found), bool)
            for r in ranges.as_py():
                stay[r["start"]:r["end"]] = False
            removed.append(len(found) - int(stay.sum()))
            kept.append(b" ".join(found[i] for i in np.flatnonzero(stay).tolist()).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("check"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["id", "check", "n_removed", "kept_text"])


def _keyed(docs: DataFrame) -> DataFrame:
    """128 bits of (doc_id, text) are a document's key; equal rows share it."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("id"),
                       F.xxhash64(F.lit(7), "text", "doc_id").alias("check"))


def _prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every document's key, word count and digest; texts with recurring phrases
    and their ranges of words to remove)."""
    docs = _keyed(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = materialise(docs.mapInArrow(
        _phrases, f"doc_id {kind}, id long, check long, n_words long, whole_sha256 string, phrases array<long>"),
        "phrases")
    named = rows.select("id", "check", F.explode("phrases").alias("phrase"))
    counted = named.groupBy("phrase").agg(F.count("*").alias("n")).where("n > 1")
    recurring = (named.distinct().join(counted.select("phrase", (F.col("n") > HOT).alias("hot")), "phrase")
                 .groupBy("id", "check").agg(F.collect_list(F.struct("phrase", "hot")).alias("recurring")))
    affected = materialise(docs.drop("doc_id").join(recurring, ["id", "check"]), "affected")
    segments = affected.mapInArrow(_segments, "shard long, id long, check long, start int, words binary")
    located = (segments.repartition("shard").sortWithinPartitions("shard")
               .mapInArrow(_shards, "id long, check long, start int, end int"))
    windows = (affected.where(F.exists("recurring", lambda x: x["hot"]))
               .mapInArrow(_hot_windows, "window long, id long, check long, start int"))
    often = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    hot = windows.join(often, "window").select("id", "check", "start", (F.col("start") + WINDOW).alias("end"))
    ranges = located.unionByName(hot).groupBy("id", "check").agg(
        F.collect_set(F.struct("start", "end")).alias("ranges"))
    return rows, affected.select("id", "check", "text").dropDuplicates(["id", "check"]).join(ranges, ["id", "check"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) for every row of ``docs``
    (doc_id, text); ``kept_text`` is null where nothing is removed."""
    rows, affected = _prepared(docs)
    cut = affected.mapInArrow(_keep, "id long, check long, n_removed long, kept_text string")
    return (rows.drop("phrases").join(cut, ["id", "check"], "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce(F.sha2("kept_text", 256), "whole_sha256").alias("kept_sha256"), "kept_text"))
