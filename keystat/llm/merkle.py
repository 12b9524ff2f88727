"""Merkle manifest of a dataset: every row is a leaf, every source a tree, one root over all.

``H`` is lower-case hex SHA-256 of its inputs written one after another, digests as hex text. A
leaf is the ``H`` of a row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its
value. A source's leaves stand in ascending order; while several nodes remain, each ``FANOUT``
consecutive ones (the last run may hold fewer, even one) become their ``H``. What remains is the
source's subroot, and the subroots, in the order of the sources, give the root in the same way.
A row's proof are the other nodes of its runs, level by level up to the root.

How it runs: leaves are numbered over the whole table (ranges of the sort key and prefix sums of
their counts, :mod:`keystat.operators.positions`), so a leaf knows its place in its source. A
**superblock** is ``FANOUT ** LOCAL`` consecutive leaves of one source, or a run of small whole
sources of about as many leaves. One pass reduces each superblock to one node a source; the outer
levels above, a few thousandths of the leaves, are reduced by grouped aggregations. Then leaves
and the outer nodes their proofs need are cogrouped by superblock: one function call reduces the
superblock again, joins local and outer siblings to proofs, and folds the claimed leaves up to the
root. A hot source is many superblocks; a superblock holds fewer than ``2 * FANOUT ** LOCAL`` leaves.

Defined results: null fields are ``-`` (an empty text is ``0:``); rows of the null source are a
source of their own, the first; rows of one key stand in the order of their leaves, null keys
first; repeated rows are leaves of their own; an empty table gives no rows; other columns of the
table are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystat.llm.common import materialise, ship_package
from keystat.operators.positions import with_positions

FANOUT = 16
LOCAL = 3  # levels within a superblock
SUPER = FANOUT ** LOCAL
#: Leaves of one source are joined with its numbers in runs of so many places.
RUN = 1 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest (32 bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def _h(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _others(run: str, place: int) -> tuple[str, str]:
    """The nodes of a run left and right of a place, as text."""
    return run[:HEX * place], run[HEX * (place + 1):]


def _levels(digests: list[str], whole: bool) -> tuple[list[list[str]], str]:
    """The runs' texts of every level of consecutive nodes, and the last node: up to one
    node for a whole source, ``LOCAL`` levels for a superblock of a larger one."""
    levels = []
    while len(digests) > 1 if whole else len(levels) < LOCAL:
        runs = ["".join(digests[i:i + FANOUT]) for i in range(0, len(digests), FANOUT)]
        levels.append(runs)
        digests = [_h(r) for r in runs]
    return levels, digests[0]


def _sources(block: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, list[list[str]], str]]:
    """(source number, its leaves in order, levels, last node) of a superblock."""
    for number, rows in block.sort_values(["ord", "idx"], kind="stable").groupby("ord", sort=True):
        levels, top = _levels([d.hex() for d in rows["leaf"]], int(rows["n"].iloc[0]) <= SUPER)
        yield number, rows, levels, top


def _reduce(block: pd.DataFrame) -> pd.DataFrame:
    """One node for each source of a superblock."""
    tops = [(block["block"].iloc[0], number, rows["idx"].iloc[0] // SUPER, top)
            for number, rows, _, top in _sources(block)]
    return pd.DataFrame(tops, columns=["block", "ord", "idx", "digest"])


def _finish(block: pd.DataFrame, outer: pd.DataFrame, root: str, proofs: bool) -> pd.DataFrame:
    """Proofs and folded roots of a superblock's leaves; ``outer`` holds the runs above it."""
    above: dict[tuple, str] = {}
    for step, tree, run, digests in zip(outer["step"], outer["tree"], outer["run"], outer["digests"]):
        above[step, tree, run] = digests
    n_steps = {t: 1 + max((s for s, tree, _ in above if tree == t), default=-1) for t in {k[1] for k in above}}
    out: list[tuple] = []
    for number, rows, levels, top in _sources(block):
        # the way from the superblock's node to the root, shared by its leaves
        way, subroot, idx = [], top, int(rows["idx"].iloc[0]) // SUPER
        for step in range(n_steps.get(number, 0)):
            run = above[step, number, idx // FANOUT]
            way.append(_others(run, idx % FANOUT))
            subroot, idx = _h(run), idx // FANOUT
        idx = number
        for step in range(n_steps.get(-1, 0)):
            way.append(_others(above[step, -1, idx // FANOUT], idx % FANOUT))
            idx //= FANOUT
        outer_proof = "".join(left + right for left, right in way)
        base = int(rows["idx"].iloc[0])
        # proofs grow downwards: a node's is its siblings, then its parent's
        tails = [outer_proof]
        for runs in reversed(levels[1:]):
            n_nodes = sum(len(r) // HEX for r in runs)
            tails = ["".join(_others(runs[i // FANOUT], i % FANOUT)) + tails[i // FANOUT] for i in range(n_nodes)]
        folded_from: dict[tuple, str] = {}

        def fold(node: str, level: int, place: int) -> str:
            """The root that a node of this level leads to."""
            if (node, level, place) not in folded_from:
                if level < len(levels):
                    left, right = _others(levels[level][place // FANOUT], place % FANOUT)
                    up = fold(_h(left + node + right), level + 1, place // FANOUT)
                else:
                    up = node
                    for left, right in way:
                        up = _h(left + up + right)
                folded_from[node, level, place] = up
            return folded_from[node, level, place]

        for key, idx, own, claimed in zip(rows["key"], rows["idx"], rows["leaf"], rows["claimed"]):
            place = int(idx) - base
            proof = outer_proof
            if levels:
                proof = "".join(_others(levels[0][place // FANOUT], place % FANOUT)) + tails[place // FANOUT]
            folded = fold(claimed.hex(), 0, place)
            out.append((key, own.hex(), subroot, root, proof if proofs else None, _h(proof), folded, folded == root))
    return pd.DataFrame(out, columns=["key", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified"])


def _runs(nodes: DataFrame) -> DataFrame:
    """(tree, run, digests): the nodes of every run, in order, as one text."""
    return (nodes.groupBy("tree", F.expr(f"idx div {FANOUT}").alias("run"))
            .agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("nodes"))  # at most FANOUT
            .select("tree", "run", F.array_join(F.col("nodes")["digest"], "").alias("digests")))


def _outer_levels(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs of each level of the trees in ``nodes`` (tree, idx, digest), idx from 0 without
    gaps, until each is one node; and those (tree, digest)."""
    levels, done = [], None
    while True:
        sizes = nodes.groupBy("tree").agg(F.max("idx").alias("last"))
        ended = nodes.join(sizes, "tree").where("last = 0").select("tree", "digest")
        nodes = nodes.join(sizes, "tree").where("last > 0").drop("last")
        done = ended if done is None else done.unionByName(ended)
        runs = materialise(_runs(nodes), f"{name}-runs")
        if not runs.limit(1).count():
            return levels, materialise(done, f"{name}-tops")
        levels.append(runs)
        nodes = runs.select("tree", F.col("run").alias("idx"), F.sha2("digests", 256).alias("digest"))


def _required(blocks: DataFrame, sources: list[DataFrame], top: list[DataFrame]) -> DataFrame:
    """(block, step, tree, run, digests): the outer runs that each superblock's proofs go
    through. ``tree`` is a source's number, or -1 above the subroots."""
    out = None
    for levels, tree, idx in ((sources, F.col("ord"), F.col("idx")), (top, F.lit(-1).cast("long"), F.col("ord"))):
        for step, runs in enumerate(levels):
            place = idx if not step else F.floor(idx / F.lit(FANOUT ** step))
            wanted = blocks.select("block", tree.alias("tree"), F.floor(place / FANOUT).alias("run")).distinct()
            rows = wanted.join(runs, ["tree", "run"]).select(
                "block", F.lit(step).alias("step"), "tree", "run", "digests")
            out = rows if out is None else out.unionByName(rows)
    if out is None:  # one superblock is all there is
        out = blocks.where(F.lit(False)).select(
            "block", F.lit(0).alias("step"), F.col("ord").alias("tree"), F.col("idx").alias("run"),
            F.col("digest").alias("digests"))
    return out


def manifest(docs: DataFrame, *, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", source: str = "source",
             claimed: dict[str, Column] | None = None, proofs: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of ``docs``.

    ``claimed`` gives fields as they are claimed to be now, from which ``folded_root`` is
    computed with the proofs of ``docs`` as it is. ``proofs=True`` adds ``proof``, the
    siblings' digests one after another."""
    ship_package(docs.sparkSession)
    own = [F.col(c) for c in fields]
    now = [(claimed or {}).get(c, F.col(c)) for c in fields]
    leaves = docs.select(F.col(key).alias("key"), F.col(source).alias("source"),
                         leaf(*own).alias("leaf"), leaf(*now).alias("claimed"))
    placed = with_positions(leaves, "source", "key", "leaf")
    groups = with_positions(placed.groupBy("source").agg(F.min("position").alias("first"), F.count("*").alias("n")),
                            "first", name="ord")
    numbered = groups.select(
        "source", (F.col("first") - 1).alias("first"), "n", (F.col("ord") - 1).alias("ord"),
        F.explode(F.sequence(F.expr(f"first div {RUN}"), F.expr(f"(first + n - 1) div {RUN}"))).alias("run"))
    small = F.col("n") <= SUPER
    idx = F.col("position") - 1 - F.col("first")
    joined = placed.withColumn("run", F.expr(f"position div {RUN}")).alias("p").join(
        numbered.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")) & (F.col("p.run") == F.col("g.run")))
    rows = materialise(joined.select(
        "key", "leaf", "claimed", "ord", "n", idx.alias("idx"),
        # of a large source, the place of the superblock's first leaf; of small ones, where they start
        F.when(small, -1 - F.expr(f"first div {SUPER}"))
        .otherwise(F.col("first") + F.floor(idx / SUPER) * SUPER).alias("block")), "leaves")
    blocks = materialise(rows.select("block", "ord", "n", "idx", "leaf").groupBy("block").applyInPandas(
        _reduce, "block long, ord long, idx long, digest string"), "superblocks")
    sources, subroots = _outer_levels(blocks.select(F.col("ord").alias("tree"), "idx", "digest"), "source")
    top, roots = _outer_levels(subroots.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("idx"),
                                               "digest"), "root")
    root = roots.first()
    root = root["digest"] if root else ""
    outer = _required(blocks, sources, top)
    key_type = docs.schema[key].dataType.simpleString()
    schema = (f"key {key_type}, leaf string, subroot string, root string, proof string, proof_sha256 string, "
              "folded_root string, verified boolean")
    if not proofs:
        schema = schema.replace("proof string, ", "")

    def finish(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        found = _finish(block, outer, root, proofs)
        if key_type in ("bigint", "int", "smallint", "tinyint"):
            found["key"] = found["key"].astype("Int64")
        return found if proofs else found.drop(columns="proof")

    return (rows.groupBy("block").cogroup(outer.groupBy("block")).applyInPandas(finish, schema)
            .withColumnRenamed("key", key))
