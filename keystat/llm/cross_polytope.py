"""Near-duplicate vectors: cross-polytope hashing, multiprobe buckets, pairs verified by cosine.

A vector is turned by three rounds of random signs and a fast Hadamard transform; the
hash is the place and sign of its greatest coordinate, one of ``2 * D`` corners of the
cross-polytope (``D``: the dimension rounded up to a power of two, ``LEAST_SIZE`` or more). A table's bucket is the
corners of several turns; a vector also probes the buckets in which one corner gives way to the
next nearest, for those corners that are closest calls. Two vectors are compared where any of their buckets is
the same.

How many turns and tables: turns so that a table has ``SPREAD`` times as many buckets as there
are vectors, hence few chance meetings at any size; tables so that a pair exactly at the threshold
shares none with a chance of ``MISS`` (estimated on random pairs at that cosine, with a fixed seed).

Equal vectors are one class from the start, whatever their number. Buckets with two classes or more get their
vectors, by a join; a large bucket is cut into blocks, and each pair of blocks is one group of
at most ``2 * BLOCK`` vectors. A group multiplies its vectors in double precision and gives no pairs:
for each vector the number of links, and the least vector that its links reach within
the group, from which components follow by joins. A pair that shares several buckets is counted in the first.

Defined results: null, empty and zero vectors and those that hold null or non-finite components link with
nothing, nor do vectors of different lengths; nor do rows without an id (their component is null and they are kept).
Equal rows are vectors of their own; all rows of one id are in one component, the
least id that any of them reaches. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.llm.common import materialise, mix, ship_package
from keystat.llm.graph import components

THRESHOLD = 0.95
SPREAD = 16
MISS = 1e-4
PROBES = 3  # further buckets of a vector in each table
BLOCK = 512
ROUNDS = 3
#: Shorter vectors are padded to this many dimensions: signs of fewer give too few different turns.
LEAST_SIZE = 32
TABLE_BITS = 8  # the first bits of a bucket's number are its table's
_TIE = 1e-9  # cosines so near the threshold are computed again, one by one


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of every row (lengths are powers of two), unscaled."""
    n, size = x.shape
    half = 1
    while half < size:
        pairs = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x


@functools.lru_cache(maxsize=64)
def _signs(size: int, turn: int) -> np.ndarray:
    return np.random.default_rng([size, turn]).choice([-1.0, 1.0], (ROUNDS, size))


def _turned(x: np.ndarray, turn: int) -> np.ndarray:
    for signs in _signs(x.shape[1], turn):
        x = _hadamard(x * signs) / math.sqrt(x.shape[1])
    return x


def _corners(x: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest and the second nearest corner of every row, and how much nearer the nearest is."""
    y = _turned(x, turn)
    size = y.shape[1]
    near = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
    value = np.take_along_axis(y, near, 1)
    swap = (np.abs(value[:, 1]) > np.abs(value[:, 0])) | (
        (np.abs(value[:, 1]) == np.abs(value[:, 0])) & (near[:, 1] < near[:, 0]))
    near[swap], value[swap] = near[swap][:, ::-1], value[swap][:, ::-1]
    corner = near + size * (value < 0)
    return corner[:, 0], corner[:, 1], np.abs(value[:, 0]) - np.abs(value[:, 1])


def _buckets(x: np.ndarray, table: int, turns: int) -> np.ndarray:
    """The numbers of a table's buckets of every row: its own, then those it probes."""
    found = [_corners(x, table * turns + t) for t in range(turns)]
    first = np.stack([f[0] for f in found], axis=1)
    second = np.stack([f[1] for f in found], axis=1)
    order = np.argsort(np.stack([f[2] for f in found], axis=1), axis=1, kind="stable")
    out = []
    for probe in range(min(PROBES, turns) + 1):
        corners = first.copy()
        if probe:
            change = order[:, probe - 1:probe]
            np.put_along_axis(corners, change, np.take_along_axis(second, change, 1), 1)
        h = np.full(len(x), x.shape[1], np.uint64)
        for t in range(turns):
            with np.errstate(over="ignore"):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + corners[:, t].astype(np.uint64) + np.uint64(1))
        out.append((np.uint64(table) << np.uint64(63 - TABLE_BITS)) | (h >> np.uint64(TABLE_BITS + 1)))
    return np.stack(out, axis=1).view(np.int64)


def _size(dimension: int) -> int:
    return max(LEAST_SIZE, 1 << max(0, dimension - 1).bit_length())


def _padded(x: np.ndarray) -> np.ndarray:
    size = _size(x.shape[1])
    return np.pad(x, ((0, 0), (0, size - x.shape[1])))


@functools.lru_cache(maxsize=64)
def tables(dimension: int, vectors: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(turns of a table, tables) for a table of so many vectors."""
    size = _size(dimension)
    turns = max(1, math.ceil(math.log(max(2, SPREAD * vectors)) / math.log(2 * size)))
    rng = np.random.default_rng([dimension, turns])
    x = rng.standard_normal((2000, max(dimension, 2)))[:, :dimension]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dimension == 1:
        return turns, 1
    y = rng.standard_normal(x.shape)
    y -= (x * y).sum(1, keepdims=True) * x
    y = threshold * x + math.sqrt(1 - threshold ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = _buckets(_padded(x), 0, turns), _buckets(_padded(y), 0, turns)
    met = (a[:, :, None] == b[:, None, :]).any((1, 2)).mean()
    return turns, min((1 << TABLE_BITS) - 1, math.ceil(math.log(MISS) / math.log1p(-min(met, 1 - 1e-9))))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (by powers of two first, so that no square overflows)."""
    _, e = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    x = np.ldexp(x, -e)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) of each length in a column of lists without nulls."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield rows, values[offsets[rows][:, None] + np.arange(n)]


def _hash_batches(batches: Iterator[pa.RecordBatch], vectors: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, x in _rows(batch.column("vector")):
            turns, n_tables = tables(x.shape[1], vectors, threshold)
            x = _padded(_unit(x))
            codes = np.concatenate([_buckets(x, t, turns) for t in range(n_tables)], axis=1)
            width = codes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(rows)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(codes.ravel()))],
                names=["node", "codes"])


def _shares_earlier(codes: np.ndarray, a: np.ndarray, b: np.ndarray, bucket: int) -> np.ndarray:
    """Whether the pairs of rows (a, b) share a bucket of a smaller number than this one."""
    earlier = np.zeros(len(a), bool)
    left = np.arange(len(a))
    per = codes.shape[1] // len(np.unique(codes[0] >> (63 - TABLE_BITS)))
    for start in range(0, codes.shape[1], per):
        part = codes[:, start:start + per]
        if not len(left) or (int(part[0, 0]) >> (63 - TABLE_BITS)) > (bucket >> (63 - TABLE_BITS)):
            break
        x, y = part[a[left]], part[b[left]]
        hit = ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] < bucket)).any((1, 2))
        earlier[left[hit]] = True
        left = left[~hit]
    return earlier


def _least_reached(linked: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The least node that each row reaches by links."""
    label = node.copy()
    while True:
        near = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(label, near)
        if (new == label).all():
            return label
        label = new


def _compare(bucket: int, side: np.ndarray, node: np.ndarray, weight: np.ndarray, codes: np.ndarray,
             x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, links, least node reached) of the vectors of one group that have links. ``side``
    is 0 or 1 where two blocks of a bucket meet, 2 within one block."""
    unit = _unit(x)
    s = unit @ unit.T
    meets = side[:, None] != side[None, :] if (side != 2).any() else ~np.eye(len(side), dtype=bool)
    linked = (s >= threshold) & meets
    for i, j in zip(*np.nonzero(np.triu((np.abs(s - threshold) < _TIE) & meets))):
        p, q = _unit(x[i:i + 1])[0], _unit(x[j:j + 1])[0]
        linked[i, j] = linked[j, i] = math.fsum(p * q) / math.sqrt(math.fsum(p * p) * math.fsum(q * q)) >= threshold
    a, b = np.nonzero(np.triu(linked))
    if not len(a):
        return a, a, a
    new = ~_shares_earlier(codes, a, b, bucket)
    links = np.bincount(a[new], weight[b[new]], len(node)) + np.bincount(b[new], weight[a[new]], len(node))
    rows = np.flatnonzero(linked.any(axis=1))
    return rows, links[rows].astype(np.int64), _least_reached(linked, node)[rows]


def _compare_groups(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of each group of a partition sorted by (bucket, left, right), group by group."""
    kept = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        kept = rows if kept is None else pa.concat_tables([kept, rows])
        keys = np.stack([kept[c].to_numpy() for c in ("bucket", "left", "right")])
        ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if len(ends):  # the last group may go on
            yield from _groups(kept.slice(0, ends[-1]), np.concatenate([[0], ends]), threshold)
            kept = kept.slice(ends[-1])
    if kept is not None and len(kept):
        yield from _groups(kept, np.array([0, len(kept)]), threshold)


def _groups(rows: pa.Table, bounds: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    rows = rows.combine_chunks()
    bucket, side, node, weight = (rows[c].to_numpy() for c in ("bucket", "side", "node", "weight"))
    lists = {}
    for name in ("codes", "vector"):
        column = rows[name].chunk(0)
        lists[name] = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    out: list[list[np.ndarray]] = [[], [], []]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a < 2 or (side[a] != 2 and (side[a:b] == side[a]).all()):
            continue
        # a bucket's number comes from the length too, but for chance: lengths meet their own kind only
        lengths = np.diff(lists["vector"][1][a:b + 1])
        for n in np.unique(lengths).tolist():
            own = a + np.flatnonzero(lengths == n)
            if len(own) < 2:
                continue
            two = [values[starts[own][:, None] + np.arange(starts[own[0] + 1] - starts[own[0]])]
                   for values, starts in lists.values()]
            found, links, least = _compare(int(bucket[a]), side[own], node[own], weight[own], two[0], two[1], threshold)
            for part, more in zip(out, (node[own][found], links, least)):
                part.append(more)
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p).astype(np.int64)) for p in out],
                                         names=["node", "links", "least"])


def near_vectors(vectors: DataFrame, *, key: str = "vec_id", column: str = "embedding",
                 threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_links, component_id, kept) for every row of ``vectors``."""
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.transform(F.col(column), lambda x: x.cast("double") + 0.0)  # -0.0 becomes 0.0
    good = F.col("key").isNotNull() & F.coalesce(
        (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0.0), F.lit(False))
    rows = materialise(vectors.select(F.col(key).alias("key"), v.alias("vector")).withColumn("good", good)
                       .withColumn("same", F.when(F.col("good"), F.sha2(F.array_join("vector", ",").cast("binary"), 256)))
                       .select("key", "same", F.when(F.col("good"), F.col("vector")).alias("vector")), "vectors")
    real = rows.where("same IS NOT NULL")
    # a class's number is fixed once written
    classes = materialise(
        real.groupBy("same").agg(F.min("key").alias("least"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    n = classes.count()
    coded = materialise(classes.select("node", "vector").mapInArrow(
        lambda batches: _hash_batches(batches, n, threshold), "node long, codes array<long>"), "codes")
    places = coded.select("node", F.explode(F.array_distinct("codes")).alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    places = materialise(places.join(shared, "bucket"), "buckets")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")
    dealt = (places.withColumn("blocks", blocks).withColumn("own", own)
             .select("bucket", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("bucket", "node", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
                     F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    payload = classes.select("node", "weight", "vector").join(coded, "node")
    groups = (dealt.join(payload, "node").repartition(parts, "bucket", "left", "right")
              .sortWithinPartitions("bucket", "left", "right"))
    found = materialise(groups.mapInArrow(lambda batches: _compare_groups(batches, threshold),
                                          "node long, links long, least long"), "links")
    return _per_row(rows, classes, found, key)


def _per_row(rows: DataFrame, classes: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The result of every row from its class's links and edges."""
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    real = rows.where("same IS NOT NULL").select("key", "same").join(classes.select("same", "node"), "same")
    # the classes of one id are one component
    ids = real.select("key", "node").distinct()
    several = ids.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("c")).where("c > 1").select("key", "a")
    edges = materialise(edges.unionByName(ids.join(several, "key").where("a <> node").select("a", F.col("node").alias("b"))),
                        "edges")
    labels = classes.select("node", "same", "least", "weight")
    if edges.limit(1).count():
        labels = labels.join(components(edges), "node", "left").withColumn("label", F.coalesce("label", "node"))
        least = labels.groupBy("label").agg(F.min("least").alias("component"))
        labels = labels.join(least, "label")
    else:
        labels = labels.withColumn("component", F.col("least"))
    labels = labels.join(links, "node", "left").select(
        "same", "component", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    return (rows.select("key", "same").join(labels, "same", "left")
            .select(F.col("key").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "key").alias("component_id"))
            .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))))
