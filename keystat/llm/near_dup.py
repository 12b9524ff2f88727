"""Near-duplicates: one-permutation MinHash, star-shaped candidates, exact links.

A document is the set of its distinct shingles (``SHINGLE`` words each, lower-cased A-Z; a
shorter text is one shingle). One hash function is the one permutation: the hash
range is cut into bins, each bin keeps its least hash, and an empty bin takes
the value of a bin drawn by a hash of (bin, attempt) - optimal densification.
Bins are grouped into bands, and equal bands put documents into one bucket.

Documents with the same set are one class from the start, whatever their
number. Among classes, the pairs of a bucket are not made: a bucket's star
compares one centre with its members, and links are confirmed on full sets. A
star alone can miss links between two members that are both unlike the centre,
so buckets go on in rounds: as long as the members that were no centre yet lie
in two or more components, the bucket gets new centres. Three exact facts keep
that short: members of one component need no test; of ``n`` shingles of which ``u``
occur in no other candidate at most ``s = n - u`` can be shared; and if two
members share ``x`` and ``y`` shingles with the same centre, they share at most
``min(x, y) + min(s - x, s' - y)`` with each other. Centres are those of the largest
``s / n``, in a family of copies its original.

With ``BANDS`` bands of ``ROWS`` bins a pair at the threshold of 0.8 shares no
bucket with a chance of about 1e-7, at 0.85 about 1e-10 (short texts: their few shingles decide,
at worst about 1e-3 where all their overlap is at the threshold).

Nulls and empty texts have no shingles and link with nothing, nor do rows
without a doc_id (their component is null and they are kept). A link is one of two
classes, so each text of a repeated doc_id is compared by itself; the components
of its texts are one. Every row is returned once; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystat.llm.common import (LOWER, SPACED_WORD, counted, gram_hashes, hand_back, handing_back, materialise, mix, ship_package,
                                text_runs, word_hashes, words)
from keystat.llm.graph import components

SHINGLE = 5
BANDS, ROWS = 40, 5
BINS = BANDS * ROWS
THRESHOLD = 80  # percent
#: A bucket gets one centre in the first round. As long as a round makes no more pairs than
#: the buckets have members, the next one gives each undecided bucket so many times as many.
GROWTH = 8
#: Bits that tell tasks which documents' full sets are wanted.
FILTER_BITS = 1 << 26


def _shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distinct sorted shingle hashes of every row, offsets) by runs."""
    for row, data, offsets in text_runs(column):
        data = LOWER[data]
        starts, ends, first = words(data, offsets, SPACED_WORD)
        h = word_hashes(data, starts, ends)
        grams = gram_hashes(h, SHINGLE)
        sets, sizes = [], np.zeros(len(first) - 1, np.int64)
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            if b - a >= SHINGLE:
                own = np.unique(grams[a:b - SHINGLE + 1])
            else:
                own = gram_hashes(h[a:b], b - a) if b > a else h[:0]
            sets.append(own)
            sizes[i] = len(own)
        yield row, np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])


def _signatures(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bins of every set with members, densified: a row of ``BINS`` values each."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    # the sets are sorted, so a bin's least hash is the first with its number
    bins = (((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    place = text * BINS + bins
    new = np.ones(len(h), bool)
    new[1:] = place[1:] != place[:-1]
    values = np.zeros(n * BINS, np.uint64)
    full = np.zeros(n * BINS, bool)
    values[place[new]] = h[new]
    full[place[new]] = True
    empty = np.flatnonzero(~full & np.repeat(np.diff(offsets) > 0, BINS))
    owner, bin_of, attempt = empty // BINS, empty % BINS, 0
    drawn = values.copy()
    while len(empty):
        attempt += 1
        donor = (mix(np.arange(BINS, dtype=np.uint64) + np.uint64(attempt << 20)) % np.uint64(BINS)).astype(np.int64)
        source = owner * BINS + donor[bin_of]
        hit = full[source]
        drawn[empty[hit]] = values[source[hit]]
        empty, owner, bin_of = empty[~hit], owner[~hit], bin_of[~hit]
    return drawn.reshape(n, BINS)


def _bands(signatures: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        cut = signatures.reshape(len(signatures), BANDS, ROWS)
        total = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signatures), 1))
        for j in range(ROWS):
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, j])
    return total.view(np.int64)


def _set_keys(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128 bits of every set: sums of two scramblings of its members."""
    with np.errstate(over="ignore"):
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(c)))]) for c in (0x5BD1E995, 0xC2B2AE3D27D4EB4F)]
        return np.stack([s[offsets[1:]] - s[offsets[:-1]] for s in sums], axis=1)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in handing_back(batches):
        for row, h, offsets in _shingles(batch.column("text")):
            n = len(offsets) - 1
            bands = _bands(_signatures(h, offsets))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(row, n), pa.array(np.diff(offsets), pa.int64()),
                 pa.array([k.tobytes() for k in _set_keys(h, offsets)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(bands.ravel()))],
                names=["doc_id", "n", "key", "bands"])


def _full_sets(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    """(key, shingles) of the rows whose id's hash ``h`` is marked in the bitmap."""
    bitmap = wanted.value
    for batch in handing_back(batches):
        bit = batch.column("h").to_numpy().view(np.uint64) & np.uint64(FILTER_BITS - 1)
        hit = (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
        for row, h, offsets in _shingles(batch.column("text").filter(pa.array(hit))):
            n = len(offsets) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.tobytes() for k in _set_keys(h, offsets)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(h.view(np.int64)))],
                names=["key", "shingles"])


def _bitmap(ids: DataFrame) -> np.ndarray:
    """``FILTER_BITS`` bits with those of the ids' hashes set; at most ``FILTER_BITS / 64`` rows reach the driver."""
    bit = F.xxhash64("doc_id").bitwiseAND(F.lit(FILTER_BITS - 1))
    found = (ids.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(F.lit(63)).cast("int").alias("b"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toArrow())
    bitmap = np.zeros(FILTER_BITS // 64, np.uint64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bitmap


def _enough(overlap: Column, n: Column, m: Column, threshold: int) -> Column:
    """Whether an overlap of sets of ``n`` and ``m`` members reaches the threshold."""
    return (100 + threshold) * overlap >= threshold * (n + m)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) with the overlap of their full sets, and whether it is enough. One side's
    set goes to the other's: each pair ships one set, not two."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set"))
    met = pairs.join(side("b"), "b").join(side("a"), "a")
    overlap = F.size(F.array_intersect("a_set", "b_set"))
    return met.select(*pairs.columns, overlap.cast("long").alias("overlap"),
                      _enough(overlap, F.size("a_set"), F.size("b_set"), threshold).alias("linked"))


def _candidates(classes: DataFrame) -> DataFrame:
    """(bucket, node) of the classes that share a bucket with another; rows are dealt once, by
    the bucket, for the counts and for what is kept."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = classes.select("node", F.explode(F.array_distinct("bands")).alias("bucket")).repartition(parts, "bucket")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1").select("bucket")
    return rows.join(shared.hint("shuffle_hash"), "bucket")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, node, shingles) of the wanted classes (key, node, doc_id), one row each. Texts stay where
    they are: a bitmap of fixed size, of the wanted ids, tells each task whose sets to make, and what it marks
    too many (and the further rows of a repeated id) falls away by an exact join."""
    marks = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted.select("doc_id")))
    hand_back()
    made = docs.where("doc_id IS NOT NULL").select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(
        lambda batches: _full_sets(batches, marks), "key binary, shingles array<long>")
    made = materialise(made.withColumn("row", F.monotonically_increasing_id()), "made")
    one = made.groupBy("key").agg(F.min("row").alias("row")).join(wanted.select("key", "node"), "key")
    return made.select("row", "shingles").join(one, "row").select("key", "node", "shingles")


def _alive(members: DataFrame, threshold: int) -> DataFrame:
    """Members (bucket, node, n, s) that the bounds let link with another of their bucket."""
    sizes = (members.groupBy("bucket", "n").agg(F.max("s").alias("s"), F.count("*").alias("c"))
             .groupBy("bucket").agg(F.collect_list(F.struct("n", "s", "c")).alias("sizes")))
    can = F.exists("sizes", lambda x: _enough(F.least(F.col("s"), x["s"]), F.col("n"), x["n"], threshold)
                   & ((x["n"] != F.col("n")) | (x["c"] > 1)))
    return members.join(sizes, "bucket").where(can).drop("sizes")


def _hubs(tried: DataFrame, centres: DataFrame) -> DataFrame:
    """For every node compared, the centre compared with most nodes (itself counts
    too, if it is one), and how much they share: (node, hub, x)."""
    own = centres.select(F.col("node").alias("hub"), "node", F.col("n").alias("x")).distinct()
    ends = tried.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.col("overlap").alias("x")).union(
        tried.select(F.col("b"), F.col("a"), F.col("overlap")))
    ends = ends.join(own.select("hub"), "hub", "left_semi").select("hub", "node", "x").unionByName(own)
    size = ends.groupBy("hub").agg(F.count("*").alias("size"))
    return (ends.join(size, "hub").groupBy("node").agg(F.max(F.struct("size", "hub", "x")).alias("best"))
            .select("node", "best.hub", "best.x"))


def link(members: DataFrame, sets: DataFrame, threshold: int) -> DataFrame | None:
    """(node, label) of the linked members, by rounds of stars; None without links.

    A bucket whose members that were no centre yet are of one component stays so: labels only
    merge. Each round goes on with the members of the others."""
    labels = done = None
    nodes, nothing = members.select("node"), F.lit(None).cast("long")
    members = members.withColumns({"label": F.col("node"), "hub": nothing, "x": nothing, "tested": F.lit(False)})
    n_centres, size = 1, members.count()
    while True:
        undecided = (members.where(~F.col("tested")).groupBy("bucket")
                     .agg(F.min("label").alias("least"), F.max("label").alias("most"))
                     .where(F.col("least") < F.col("most")).select("bucket"))
        now, n = counted(members.join(undecided, "bucket"), "open")
        if not n:
            return labels
        best = Window.partitionBy("bucket").orderBy((F.col("s") / F.col("n")).desc(), F.col("n").desc(), "node")
        centres = materialise(
            now.where(~F.col("tested")).withColumn("place", F.row_number().over(best))
            .where(F.col("place") <= n_centres).drop("place"), "centres")
        columns = ["node", "label", "n", "s", "hub", "x"]
        once = F.lit(True)
        met, stars = now, centres
        if n_centres > 1:
            # a pair is made in the first undecided bucket that it shares, not in all
            shared = now.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
            met, stars = now.join(shared, "node"), centres.join(shared, "node")
            columns.append("buckets")
            once = F.array_min(F.array_intersect("buckets", "centre_buckets")) == F.col("bucket")
        star = stars.select("bucket", *[F.col(c).alias(f"centre_{c}") for c in columns])
        most = F.least("s", "centre_s", F.when(
            F.col("hub") == F.col("centre_hub"),
            F.least("x", "centre_x") + F.least(F.col("s") - F.col("x"), F.col("centre_s") - F.col("centre_x"))))
        pairs = (met.join(star, "bucket")
                 .where((F.col("label") != F.col("centre_label"))
                        & _enough(most, F.col("n"), F.col("centre_n"), threshold) & once)
                 .select(F.least("node", "centre_node").alias("a"), F.greatest("node", "centre_node").alias("b"),
                         F.least("label", "centre_label").alias("label_a"), F.greatest("label", "centre_label").alias("label_b"))
                 .distinct())
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs, made = counted(pairs, "pairs")
        ends = pairs.select("a", "b")
        done = ends if done is None else done.unionByName(ends)
        tried, found = counted(_confirmed(pairs, sets, threshold), "links", F.col("linked"))
        # whom the round has tested, how near each node is to the centre of most, and the new labels
        was_centre = centres.select("bucket", "node", F.lit(True).alias("was_centre"))
        members = (now.join(was_centre, ["bucket", "node"], "left")
                   .withColumn("tested", F.col("tested") | F.coalesce("was_centre", F.lit(False))).drop("was_centre"))
        if n_centres == 1:
            members = members.drop("hub", "x").join(_hubs(tried, centres), "node", "left")
        if found:
            merged = components(tried.where("linked").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).select(
                F.col("node").alias("label"), F.col("label").alias("least"))
            lower = F.coalesce("least", "label").alias("label")
            members = members.join(merged, "label", "left").select(*members.drop("label").columns, lower)
            if labels is None:
                labels = nodes.distinct().withColumn("label", F.col("node"))
            labels = materialise(labels.join(merged, "label", "left").select("node", lower), "labels")
        members = materialise(members, "members")
        if made <= size:
            n_centres *= GROWTH


def near_duplicates(docs: DataFrame, *, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sketches = materialise(docs.mapInArrow(
        _sketch, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, key binary, bands array<long>"),
        "sketches")
    real = sketches.where("n > 0 AND doc_id IS NOT NULL")
    repeated = materialise(real.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    # a class's number is fixed once written
    classes = materialise(real.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
                          .withColumn("node", F.monotonically_increasing_id()), "classes")
    candidates = materialise(_candidates(classes), "candidates")
    wanted = materialise(classes.select("key", "node", "doc_id").join(candidates.select("node").distinct(), "node"), "wanted")
    sets = materialise(_sets(docs, wanted), "sets")
    own = (sets.select("node", F.explode("shingles").alias("x")).groupBy("x")
           .agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
           .groupBy("node").agg(F.count("*").alias("u")))
    sizes = sets.select("node", "key", F.size("shingles").cast("long").alias("n")).join(own, "node", "left").select(
        "node", "key", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("s"))
    members = materialise(
        _alive(candidates.join(sizes.drop("key"), "node"), threshold), "members")
    labels = link(members, sets, threshold)
    reps = classes.select("key", F.col("doc_id").alias("least"))
    if labels is not None:
        linked = labels.join(sets.select("node", "key"), "node").join(reps, "key").select("key", "label", "least")
        least = linked.groupBy("label").agg(F.min("least").alias("component"))
        found = linked.select("key", "label").join(least, "label").select("key", "component")
        reps = reps.join(found, "key", "left").select("key", F.coalesce("component", "least").alias("least"))
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    rows = sketches.select("doc_id", "n", "key").join(reps, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), (~alone).alias("real"))
    if not repeated.isEmpty():
        rows = _texts_of_one_id(materialise(rows, "rows"), repeated)
    return rows.drop("real").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _texts_of_one_id(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with one component where the texts of a repeated doc_id had several."""
    own = rows.where("real").join(repeated, "doc_id").select("doc_id", "component_id").distinct()
    least = own.groupBy("doc_id").agg(F.min("component_id").alias("a"))
    edges = own.join(least, "doc_id").where(F.col("a") < F.col("component_id")).select(
        "a", F.col("component_id").alias("b"))
    joined = components(edges).select(F.col("node").alias("component_id"), "label")
    return rows.join(joined, "component_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("real"), F.coalesce("label", "component_id")).otherwise(F.col("component_id")).alias("component_id"),
        "real")


def drop_near_duplicates(docs: DataFrame, *, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component; rows that repeat a doc_id are one."""
    found = materialise(near_duplicates(docs, threshold=threshold), "near")
    dropped = materialise(found.where(~F.col("kept")).select("doc_id").distinct(), "dropped")
    repeated = materialise(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
                           .select("doc_id"), "repeated")
    kept = docs.join(dropped, "doc_id", "left_anti")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    return (kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
            .unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)))
