"""Approximate nearest neighbours: a small-world graph per shard, results merged.

Vectors are dealt to shards by a hash; each shard builds a hierarchical navigable
small-world graph and stores it as flat arrays: neighbours of layer 0 (``2 * M`` a
vector, -1 where there is none), of each higher layer (``M``), and the vectors. The index is
a table of one row per shard. A query searches every shard, and the shards' nearest are merged.

Nearness is the inner product. For the graph each vector gets one more
component that makes all lengths equal to the largest, so that the largest inner products are the
nearest neighbours; a query's is 0. Equal vectors are one node with their
ids, of which the ``k + 1`` smallest can be needed, so copies cost no quality; ids
of one vector are thinned before they meet. Scores are computed again from the original components in double precision.

Vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do rows without an id; vectors meet only those of their own dimension. Rows
that share an id and a vector are one candidate. Extra columns are ignored; an empty table
gives an empty result. Queries go to the tasks in blocks of ``QUERY_BLOCK``; the index is built and
written once, with ``SHARD_ROWS`` rows a shard at most on average, and at least ``MIN_SHARDS``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keystat.llm.common import materialise

M = 12
BUILD_BREADTH = 64
SEARCH_BREADTH = 96
SHARD_ROWS = 50_000
MIN_SHARDS = 12
QUERY_BLOCK = 50_000


class Graph:
    """A navigable small-world graph over rows of equal length, as flat arrays."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray] | None = None,
                 levels: np.ndarray | None = None, entry: int = 0):
        self.vectors = vectors
        self.entry = entry
        if layers is None:
            n = len(vectors)
            # a layer holds about 1 / M of the one below
            draws = np.random.default_rng(1).random(n)
            self.levels = np.minimum((-np.log(1 - draws) / math.log(M)).astype(np.int8), 6)
            self.layers = [np.full((n, 2 * M if not i else M), -1, np.int32)
                           for i in range(int(self.levels.max(initial=0)) + 1)]
            self._build()
        else:
            self.layers, self.levels = layers, levels

    def _build(self) -> None:
        top = -1
        for i, level in enumerate(self.levels.tolist()):
            if top < 0:
                self.entry, top = i, level
                continue
            q, near = self.vectors[i], [(float(self.vectors[i] @ self.vectors[self.entry]), self.entry)]
            for layer in range(top, -1, -1):
                if layer > level:
                    near = self._search(q, near, 1, layer)
                    continue
                near = self._search(q, near, BUILD_BREADTH, layer)
                chosen = self._spread(near, M)
                self.layers[layer][i, :len(chosen)] = chosen
                for j in chosen:
                    self._connect(layer, j, i)
            if level > top:
                self.entry, top = i, level

    def _spread(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours, nearest first, that are nearer to the new one than to one another."""
        ids = [j for _, j in near]
        v = self.vectors[ids]
        among = v @ v.T
        chosen: list[int] = []
        for a, (s, _) in enumerate(near):
            if all(among[a, b] < s for b in chosen):
                chosen.append(a)
                if len(chosen) == most:
                    break
        for a in range(len(near)):  # fill up with the nearest left out
            if len(chosen) >= min(most, len(near)):
                break
            if a not in chosen:
                chosen.append(a)
        return [ids[a] for a in chosen]

    def _connect(self, layer: int, j: int, i: int) -> None:
        row = self.layers[layer][j]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = i
            return
        ids = np.append(row, i)
        scores = self.vectors[ids] @ self.vectors[j]
        order = np.argsort(-scores, kind="stable")
        kept = self._spread([(float(scores[o]), int(ids[o])) for o in order], len(row))
        row[:] = -1
        row[:len(kept)] = kept

    def _search(self, q: np.ndarray, start: list[tuple[float, int]], breadth: int, layer: int) -> list[tuple[float, int]]:
        """The ``breadth`` nearest found from ``start``, nearest first."""
        links, vectors = self.layers[layer], self.vectors
        seen = {j for _, j in start}
        todo = [(-s, j) for s, j in start]
        heapq.heapify(todo)
        found = list(start)
        heapq.heapify(found)
        while len(found) > breadth:
            heapq.heappop(found)
        while todo:
            s, j = heapq.heappop(todo)
            if -s < found[0][0] and len(found) >= breadth:
                break
            new = [x for x in links[j].tolist() if x >= 0 and x not in seen]
            if not new:
                continue
            seen.update(new)
            scores = (vectors[new] @ q).tolist()
            full, least = len(found) >= breadth, found[0][0]
            for x, score in zip(new, scores, strict=True):
                if not full:
                    heapq.heappush(found, (score, x))
                    heapq.heappush(todo, (-score, x))
                    full, least = len(found) >= breadth, found[0][0]
                elif score > least:
                    heapq.heapreplace(found, (score, x))
                    heapq.heappush(todo, (-score, x))
                    least = found[0][0]
        return sorted(found, reverse=True)

    def nearest(self, q: np.ndarray, breadth: int) -> list[int]:
        if not len(self.vectors):
            return []
        near = [(float(q @ self.vectors[self.entry]), self.entry)]
        for layer in range(len(self.layers) - 1, 0, -1):
            near = self._search(q, near, 1, layer)
        return [j for _, j in self._search(q, near, breadth, 0)]


_INDEX = ("dim int, shard int, n int, entry int, original binary, flat binary, levels binary, "
          "layers array<binary>, ids array<long>, offsets array<int>")


def _build_shard(largest: float):
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        dim = int(frame["dim"].iloc[0])
        frame = frame.sort_values("least").reset_index(drop=True)  # any order of tasks gives one graph
        original = np.frombuffer(b"".join(frame["vector"]), np.float64).reshape(-1, dim)
        extra = np.sqrt(np.maximum(largest - (original ** 2).sum(axis=1), 0))
        flat = np.concatenate([original, extra[:, None]], axis=1).astype(np.float32)
        graph = Graph(flat)
        ids = [list(x) for x in frame["ids"]]
        return pd.DataFrame([{
            "dim": dim, "shard": int(frame["shard"].iloc[0]), "n": len(frame), "entry": graph.entry,
            "original": original.tobytes(), "flat": flat.tobytes(), "levels": graph.levels.tobytes(),
            "layers": [x.tobytes() for x in graph.layers], "ids": [x for part in ids for x in part],
            "offsets": np.cumsum([0, *map(len, ids)]).tolist()}])

    return build


def _search_shards(shared, k: int, breadth: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, queries = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                original = np.frombuffer(row["original"]).reshape(-1, dim)
                layers = [np.frombuffer(x, np.int32).reshape(row["n"], -1) for x in row["layers"]]
                graph = Graph(np.frombuffer(row["flat"], np.float32).reshape(-1, dim + 1), layers,
                              np.frombuffer(row["levels"], np.int8), row["entry"])
                ids, offsets = row["ids"], row["offsets"]
                out: list[tuple[int, int, float]] = []
                for own, q in zip(own_ids.get(dim, ()), queries.get(dim, ()), strict=True):
                    found = graph.nearest(np.append(q, 0).astype(np.float32), breadth)
                    scores = original[found] @ q
                    best = sorted(((-s, x) for s, j in zip(scores.tolist(), found, strict=True)
                                   for x in ids[offsets[j]:offsets[j + 1]] if x != own))
                    out += [(own, x, -s) for s, x in best[:k]]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64()),
                                                        strict=True)], names=["query_id", "vec_id", "score"])

    return search


def _usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, v, dim) of the rows that take part; ``v`` holds doubles."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & good
                       & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")))


def build_index(vectors: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """The index table over all usable rows of ``vectors``, written once."""
    rows = _usable(vectors, id_column, vector)
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    total = rows.agg(F.count("*").alias("n"), F.max(square).alias("largest")).first()
    if not total["n"]:
        return rows.sparkSession.createDataFrame([], _INDEX)
    shards = max(MIN_SHARDS, -(-total["n"] // SHARD_ROWS))
    # the k + 1 least ids of a vector, first by parts of its ids
    parts = rows.distinct().withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    least = (parts.groupBy("v", "dim", "part").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
             .select("v", "dim", F.slice("ids", 1, k + 1).alias("ids")))
    nodes = (least.groupBy("v", "dim").agg(F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
             .select("dim", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), F.col("v"), "ids",
                     F.col("ids")[0].alias("least")))
    packed = nodes.mapInArrow(_pack, "dim int, shard int, vector binary, ids array<long>, least long")
    return materialise(packed.groupBy("dim", "shard").applyInPandas(_build_shard(total["largest"]), _INDEX), "index")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v = [x.values.to_numpy().tobytes() for x in batch.column("v")]
        yield pa.RecordBatch.from_arrays([batch.column("dim"), batch.column("shard"), pa.array(v, pa.binary()),
                                          batch.column("ids"), batch.column("least")],
                                         names=["dim", "shard", "vector", "ids", "least"])


def search(index: DataFrame, queries: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding", k: int = 20,
           breadth: int = SEARCH_BREADTH) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found, without itself."""
    spark = index.sparkSession
    asked = _usable(queries, id_column, vector).distinct()
    n = asked.count()
    blocks = max(1, -(-n // QUERY_BLOCK))
    found = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == b).toArrow()
        by_dim: dict[int, list] = {}
        for own, v, dim in zip(block.column("vec_id").to_pylist(), block.column("v").to_pylist(),
                               block.column("dim").to_pylist(), strict=True):
            by_dim.setdefault(dim, []).append((own, v))
        shared = spark.sparkContext.broadcast((
            {d: [own for own, _ in rows] for d, rows in by_dim.items()},
            {d: np.array([v for _, v in rows]) for d, rows in by_dim.items()}))
        # one shard's graph a task: the index rows are few and heavy
        part = (index.repartition("dim", "shard")
                .mapInArrow(_search_shards(shared, k, breadth), "query_id long, vec_id long, score double"))
        if blocks > 1:
            part = materialise(part, "nearest")
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
