"""Merkle manifest, collocations and near-duplicate vectors against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests_llm import SCHEMA, llm_spark  # noqa: F401

from keystat.llm import collocations as C
from keystat.llm import cross_polytope as P
from keystat.llm import merkle as M


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -- manifest ------------------------------------------------------------------------

def _leaf(row) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(nodes):
    """(root, proofs): every node's sides, level by level."""
    sides = [[] for _ in nodes]
    own = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, members = [], []
        for i in range(0, len(nodes), 16):
            run = nodes[i:i + 16]
            for j in range(len(run)):
                for leaf in own[i + j]:
                    sides[leaf].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(h("".join(run)))
            members.append([leaf for j in range(len(run)) for leaf in own[i + j]])
        nodes, own = up, members
    return (nodes or [""])[0], sides


def _manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(((r[0] is not None, r[0] or 0), _leaf((r[0], r[3], r[2], r[4], r[1])), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        members = sorted(groups[name], key=lambda x: x[:2])
        trees.append((members, *_tree([m[1] for m in members])))
    root, tops = _tree([t[1] for t in trees])
    out = []
    for (members, subroot, sides), top in zip(trees, tops):
        for (_, leaf, row), own in zip(members, sides):
            proof = "".join(a + b for a, b in own + top)
            text = row[1]
            if row[0] is not None and __import__("zlib").crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            node = _leaf((row[0], row[3], row[2], row[4], text))
            for a, b in own + top:
                node = h(a + node + b)
            out.append((row[0], leaf, subroot, root, h(proof), node, node == root))
    return out


def _claimed():
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(tampered, lower).otherwise(F.col("text"))}


MANIFESTS = {
    "empty": [],
    "one": [(7, "Text", "en", "s", 4)],
    "one source of two levels": [(i, f"Doc {i}", "en", "s", i) for i in range(40, 0, -1)],
    "sources of one row": [(i, f"Doc {i}", "en", f"s{i % 300}", i) for i in range(300)],
    "nulls and repeats": [
        (None, None, None, None, None), (None, "x", "en", None, 1), (3, "", "en", "", 0), (3, "", "en", "", 0),
        (5, "ÄBC é", None, "b", None), (5, "other", "de", "b", 5), (6, "A" * 100000, "de", "B", 100000), (-2, "neg", "de", "b", 3)],
    # a superblock holds 4096 leaves: one source of two superblocks, the last of one leaf, among small ones
    "superblocks": [(i, f"T{i}", "en", "hot", 1) for i in range(4097)] + [(i, f"T{i}", "en", f"s{i % 40}", 1) for i in range(700)],
}


@pytest.mark.parametrize("name", MANIFESTS)
def test_manifest(llm_spark, name):  # noqa: F811
    rows = MANIFESTS[name]
    docs = llm_spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit("clash")).withColumn("root", F.lit(1))
    found = M.manifest(docs, claimed=_claimed()).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(_manifest(rows), key=key)
    if name == "superblocks":
        assert {r.verified for r in found} == {True, False}


def test_proofs_are_returned(llm_spark):  # noqa: F811
    docs = llm_spark.createDataFrame(MANIFESTS["one source of two levels"], SCHEMA)
    for r in M.manifest(docs, proofs=True).collect():
        assert h(r.proof) == r.proof_sha256 and r.folded_root == r.root and r.verified


# -- collocations --------------------------------------------------------------------

def _collocations(rows, min_count, top, covered=100):
    counts, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for size in range(1, 6):
                for i in range(len(ws) - size + 1):
                    counts[lang, tuple(ws[i:i + size])] += 1
    kept = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    drop = set()
    for (lang, ws), f in kept.items():
        for size in range(2, len(ws)):
            for i in range(len(ws) - size + 1):
                part = lang, ws[i:i + size]
                if 100 * f >= covered * counts[part]:
                    drop.add(part)
    found = defaultdict(list)
    for (lang, ws), a in kept.items():
        if (lang, ws) not in drop:
            cuts = []
            for k in range(1, len(ws)):
                left, right = counts[lang, ws[:k]], counts[lang, ws[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found[lang].append((-score, -a, " ".join(ws).encode(), a, left, right, n[lang], score))
    return sorted((lang, i + 1, x[2].decode(), *x[3:]) for lang, xs in found.items() for i, x in enumerate(sorted(xs)[:top]))


def _phrase_rows(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c", "dé", "é", "New", "york", "x'y", "1", "\x1f"]
    def text():
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " new york city "])
                       for _ in range(rng.randrange(0, 60)))
    return [(i % 50, text(), rng.choice(["en", "en", "en", "de", None, "und"]), "s", 1) for i in range(docs)]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations(llm_spark, seed):  # noqa: F811
    rows = _phrase_rows(seed) + [(900, None, "en", "s", 0), (None, "", "fr", "s", 0), (None, "New York City " * 4000, "en", "s", 1)]
    rows += rows[:3]
    docs = llm_spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("phrase", F.lit("clash")).withColumn("n", F.lit(1))
    for top, covered in ((5, 100), (100000, 60)):
        found = C.collocations(docs, min_count=7, top=top, covered=covered).select(*COLUMNS).collect()
        assert sorted(map(tuple, found)) == _collocations(rows, 7, top, covered)


def test_collocations_of_nothing(llm_spark):  # noqa: F811
    assert C.collocations(llm_spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.collocations(llm_spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).collect() == []


def test_pointer_is_the_least_document(llm_spark):  # noqa: F811
    rows = [(i, "one two. one two", "en", "s", 1) for i in (9, 4, 6)] + [(None, "one two", "en", "s", 1)]
    found = C.collocations(llm_spark.createDataFrame(rows, SCHEMA), min_count=2).collect()
    assert [(r.phrase, r.a, r.pointer) for r in found] == [("one two", 7, 4)]


def test_equal_fingerprints_are_told_apart_by_text():
    """All words and phrases share their hashes: only bytes tell them apart."""
    import pyarrow as pa
    batch = pa.record_batch({"doc_id": [1, 2, 3], "lang": ["en", "en", "de"],
                             "text": ["ab cd ab  cd", "cd ab\tcd xyz. ab", "ab cd"]})
    ones = np.full(C.FILTER_BITS // 64, ~np.uint64(0))
    hashes, prints = C.word_hashes, C._Run.fingerprints
    try:
        C.word_hashes = lambda data, starts, ends: np.full(len(starts), 5, np.uint64)
        C._Run.fingerprints = lambda self, places, n: np.full(len(places), 9, np.uint64)
        class Value:
            value = (ones, ones, ones)
        out = Counter()
        for b in C._phrase_batches(iter([batch]), Value):
            for r in b.to_pylist():
                out[r["lang"], r["phrase"]] += r["count"]
    finally:
        C.word_hashes, C._Run.fingerprints = hashes, prints
    assert out["en", "ab"] == 4 and out["en", "cd"] == 4 and out["en", "xyz"] == 1 and out["de", "ab"] == 1
    assert out["en", "ab cd"] == 3 and out["en", "cd ab"] == 2 and out["en", "cd ab cd xyz"] == 1 and out["de", "ab cd"] == 1
    assert ("en", "xyz ab") not in out


def test_association_is_exact(llm_spark):  # noqa: F811
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        a = rng.randrange(100, 10 ** rng.randrange(3, 13))
        left, right = a + rng.randrange(0, 10 ** 9), a + rng.randrange(0, 10 ** 9)
        rows.append((a, left, right, rng.randrange(max(left, right), 10 ** 16)))
    # a quotient that rounds up as a fraction, and a product over 64 bits
    rows += [(3 * 10 ** 9, 3 * 10 ** 9, 10 ** 15 + 1, 10 ** 18), (10 ** 12, 10 ** 12, 10 ** 12, 9 * 10 ** 15)]
    df = llm_spark.createDataFrame(rows, "a long, l long, r long, n long")
    found = df.select("a", "l", "r", "n", C.association(F.col("a"), F.col("l"), F.col("r"), F.col("n")).alias("s")).collect()
    for r in found:
        assert r.s == 1000 * r.a * r.n // (r.l * r.r)


# -- near vectors ----------------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def _near(rows, threshold=0.95):
    good = []
    for i, (key, v) in enumerate(rows):
        ok = key is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        good.append(np.array(v) / np.abs(v).max() if ok else None)
    links = defaultdict(set)
    for i, x in enumerate(good):
        for j, y in enumerate(good[:i]):
            if x is not None and y is not None and len(x) == len(y):
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    label = {k: k for k, _ in rows}
    moved = True
    while moved:
        moved = False
        for i, js in links.items():
            for j in js:
                least = min(label[rows[i][0]], label[rows[j][0]])
                for k in (rows[i][0], rows[j][0]):
                    if label[k] != least:
                        label[k], moved = least, True
    return sorted([(k, len(links[i]), label[k], k == label[k]) for i, (k, _) in enumerate(rows)], key=repr)


def _found(spark, rows, schema=VECTORS):
    df = spark.createDataFrame(rows, schema).withColumn("n_links", F.lit("clash")).withColumn("node", F.lit(1))
    return sorted(map(tuple, P.near_vectors(df).collect()), key=repr)


def test_vectors_at_the_threshold(llm_spark):  # noqa: F811
    """Random vectors, partners at cosines from 0.94 to 0.96 and close ones, in several dimensions."""
    rng = np.random.default_rng(5)
    rows = []
    for dim in (3, 24, 64):
        base = rng.standard_normal((120, dim))
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        for x in base:
            rows.append(x)
            for c in (rng.uniform(0.94, 0.96), rng.uniform(0.9501, 0.97), 0.999):
                y = rng.standard_normal(dim)
                y -= (x @ y) * x
                rows.append((c * x + math.sqrt(1 - c * c) * y / np.linalg.norm(y)) * rng.uniform(0.1, 9))
    rows = [(int(k), v.tolist()) for k, v in zip(rng.permutation(len(rows)), rows)]
    want, got = _near(rows), _found(llm_spark, rows)
    assert [r[0] for r in want] == [r[0] for r in got]
    assert sum(r[1] for r in got) >= 0.999 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # no link below the threshold, none counted twice
    assert sum(g == w for g, w in zip(got, want)) >= 0.98 * len(want)


def test_copies_and_a_large_group(llm_spark):  # noqa: F811
    """A third of the rows are one vector, a third lie within one group of more than a block."""
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(16)
    rows = [(i, [1.0, -0.0, 2.0] + [0.0] * 13) for i in range(700)]
    rows += [(1000 + i, (centre + 0.02 * rng.standard_normal(16)).tolist()) for i in range(P.BLOCK + 200)]
    rows += [(3000 + i, rng.standard_normal(16).tolist()) for i in range(400)]
    assert _found(llm_spark, rows) == _near(rows)


def test_vectors_without_a_direction(llm_spark):  # noqa: F811
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, -0.0]), (4, [1.0, None, 3.0]), (5, [1.0, float("nan"), 3.0]),
            (6, [float("inf"), 2.0, 3.0]), (7, v), (8, v), (8, v), (9, [2.0, 4.0, 6.0]), (None, v), (None, v),
            (10, [1.0]), (11, [2.0]), (12, [-2.0]), (13, [1e200, 2e200, 3e200]), (14, [1e-200, 2e-200, 3e-200]),
            (15, [1.0, 2.0, 3.0, 0.0]), (9, [0.0, 1.0, -1.0]), (16, [0.0, 2.0, -2.0])]
    got = _found(llm_spark, rows)
    assert len(got) == len(rows)
    assert got == _near(rows)
    assert _found(llm_spark, []) == []


def test_single_precision_vectors(llm_spark):  # noqa: F811
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
    assert _found(llm_spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.5, 0.25])], schema) == [
        (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
