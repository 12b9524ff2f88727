"""Near-duplicates, repeated passages and decontamination, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm import frame, llm_spark  # noqa: F401

from keystat.llm import decontaminate as dec
from keystat.llm import near_dup, repeats

EDGE = [None, "", " \n", "one", "ONE", "one two three", "w" * 100_000, "v " * 30_000]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def shingles(text):
    w = spaced(lower(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_texts(seed, families=12, size=9):
    """Families of copies with a few words changed, some chained, and lone texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([7, 30, 80, 150]))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            if rng.random() < 0.3:
                base = copy
    return texts + [" ".join(word() for _ in range(40)) for _ in range(20)]


def plain_components(ids, sets, threshold=80):
    label = {i: i for i in ids}
    links = [(a, b) for x, a in enumerate(ids) for y, b in enumerate(ids) if x < y and sets[x] and sets[y]
             and 100 * len(sets[x] & sets[y]) >= threshold * len(sets[x] | sets[y])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("threshold", [80, 85])
def test_near_duplicates(llm_spark, seed, threshold):
    texts = near_texts(seed) + EDGE + [EDGE[7].upper()]
    ids = list(range(1, len(texts) + 1))
    random.Random(seed).shuffle(ids)
    sets = [shingles(t) for t in texts]
    want = plain_components(ids, sets, threshold)
    rows = near_dup.near_duplicates(frame(llm_spark, texts, ids), threshold=threshold).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {
        i: (len(s), want[i], want[i] == i) for i, s in zip(ids, sets, strict=True)}


def test_near_duplicates_keep_rows(llm_spark):
    text = "a b c d e f g h"
    docs = frame(llm_spark, [text, text, text, "", "", None], [5, 5, None, None, 3, 4]).withColumn("n", F.lit(1))
    rows = near_dup.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows), key=str) == sorted([
        (5, 4, 5, True), (5, 4, 5, True), (None, 4, None, True), (None, 0, None, True), (3, 0, 3, True),
        (4, 0, 4, True)], key=str)
    left = near_dup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter({5: 1, None: 2, 3: 1, 4: 1})
    none = frame(llm_spark, [])
    assert near_dup.near_duplicates(none).collect() == [] and near_dup.drop_near_duplicates(none).collect() == []


@pytest.mark.parametrize("seed", [0, 1])
def test_repeated_ids_beside_other_classes(llm_spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))

    def changed(base, n):
        return base[:len(base) - n] + [word() for _ in range(n)]

    rows = []
    for i in range(0, 400, 20):  # ids of a family: i repeated as it is, i + 2 and i + 5 with two texts
        base, other = [word() for _ in range(60)], [word() for _ in range(60)]
        below, above = changed(base, 16), changed(base, 2)
        rows += [(i, base)] * 3 + [(i + 1, below)] + [(i + 2, changed(other, 3)), (i + 2, changed(base, 17))]
        rows += [(i + 3, above), (i + 4, other), (i + 5, changed(below, 1)), (i + 5, [word() for _ in range(60)])]
    rng.shuffle(rows)
    sets = [shingles(" ".join(w)) for _, w in rows]
    place = plain_components(list(range(len(rows))), sets)
    label = {p: i for p, (i, _) in enumerate(rows)}
    for _ in rows:  # the least id over the links and the rows of an id
        for group in (place.get, lambda p: rows[p][0]):
            least = {}
            for p in label:
                least[group(p)] = min(label[p], least.get(group(p), label[p]))
            label = {p: least[group(p)] for p in label}
    docs = frame(llm_spark, [" ".join(w) for _, w in rows], [i for i, _ in rows])
    got = near_dup.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == Counter(
        (i, len(sets[p]), label[p], label[p] == i) for p, (i, _) in enumerate(rows))
    left = Counter(r["doc_id"] for r in near_dup.drop_near_duplicates(docs).collect())
    assert left == Counter({i for p, (i, _) in enumerate(rows) if label[p] == i})


def test_decided_buckets_leave_the_rounds(llm_spark, monkeypatch):
    texts = near_texts(3, families=6)
    texts += [f"{t} {i}" for i, t in enumerate(near_texts(4, families=40, size=1)[:40]) for _ in range(2)]
    rounds, counted = [], near_dup.counted

    def seen(df, name, *flag):
        written, n = counted(df, name, *flag)
        if name == "open":
            rounds.append((n, {r["bucket"] for r in written.collect()}))
        return written, n

    monkeypatch.setattr(near_dup, "counted", seen)
    ids, sets = list(range(len(texts))), [shingles(t) for t in texts]
    want = plain_components(ids, sets)
    got = near_dup.near_duplicates(frame(llm_spark, texts, ids)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert len(rounds) > 2 and rounds[-1][0] == 0
    for (n, buckets), (later, still) in zip(rounds, rounds[1:], strict=False):
        assert later < n and still < buckets


def test_densified_bins_estimate_similarity():
    rng = np.random.default_rng(4)
    shared, own = rng.integers(0, 1 << 62, 340).astype(np.uint64), rng.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([shared, own[:30]])), np.unique(np.concatenate([shared, own[30:]])), shared[:1]]
    sig = near_dup._signatures(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert abs((sig[0] == sig[1]).mean() - 340 / 400) < 0.12
    assert (sig[2] == shared[0]).all()


def plain_repeats(texts):
    found = [spaced(t) for t in texts]
    count = Counter(tuple(w[i:i + 35]) for w in found for i in range(len(w) - 34))
    out = []
    for w in found:
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i:i + 35])] > 1 for j in range(i, i + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(6)
    word = lambda: rng.choice("ab") * rng.randint(1, 3) + rng.choice("xyz")
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 20)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += [word() for _ in range(rng.randint(0, 30))] + rng.choice(passages)
        texts.append("\t".join(parts))
    return texts + EDGE + [" ".join(["same"] * 35), " ".join(["same"] * 3 + ["é"] + ["same"] * 40), texts[3]]


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_repeats(llm_spark, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)  # 2: every phrase that recurs often goes window by window
    monkeypatch.setattr(repeats, "SHARD_SEGMENTS", 50)
    texts = repeat_texts()
    rows = repeats.remove_repeats(frame(llm_spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r)[1:4] for r in rows] == plain_repeats(texts)


def test_repeated_rows_and_null_ids(llm_spark):
    long = " ".join(f"w{i}" for i in range(40))
    texts = [long, long, "short", None, " ".join(f"v{i}" for i in range(40))]
    rows = repeats.remove_repeats(frame(llm_spark, texts, [7, 7, None, None, None])).collect()
    assert sorted((tuple(r)[1:4]) for r in rows) == sorted(plain_repeats(texts))
    assert repeats.remove_repeats(frame(llm_spark, [])).collect() == []


def letters(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def plain_matches(texts, items):
    windows = {}
    for item, text in items:
        w = letters(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault((k, tuple(w[i:i + k])), set()).add(item or "")
    out = []
    for text in texts:
        w, hit, found = letters(text), set(), set()
        for k in {k for k, _ in windows}:
            for i in range(len(w) - k + 1):
                if (k, tuple(w[i:i + k])) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[k, tuple(w[i:i + k])]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [dec.BLOCK_BYTES, 300])
def test_matches(llm_spark, block_bytes):
    rng = random.Random(8)
    word = lambda: rng.choice(["the", "of", "É", "x9", "ab", "cd", "ef", "gh"])
    items = [(str(i), " ".join(word() for _ in range(rng.choice([1, 4, 9, 10, 11, 25])))) for i in range(2, 20)]
    items += [("50", "Alpha, beta!"), ("51", ""), (None, "gamma delta epsilon"), ("52", None), items[0]]
    items = [i for i in items if i[1] is None or len(letters(i[1])) != 1] + [("53", "solo")]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += [word() for _ in range(rng.randint(0, 12))] + letters(rng.choice(items)[1])
        texts.append("-".join(parts).upper())
    texts += [*EDGE, "alpha beta", "Solo", texts[1]]
    benchmark = llm_spark.createDataFrame(items, "item_id string, text string").withColumn("matches", F.lit(1))
    docs = frame(llm_spark, texts).withColumn("items", F.lit("clash"))
    rows = dec.find_matches(docs, benchmark, block_bytes=block_bytes).orderBy("doc_id").collect()
    left = dec.decontaminate(docs.withColumn("n_hit", F.lit("own")), benchmark, block_bytes=block_bytes)
    assert left.columns == [*docs.columns, "n_hit"]
    assert sorted(r["doc_id"] for r in left.collect()) == [r["doc_id"] for r in rows if not r["n_hit"]]
    want = plain_matches(texts, items)
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in rows] == want
    left = dec.decontaminate(docs, benchmark, block_bytes=block_bytes)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, w in enumerate(want, 1) if not w[1]]
    for r in rows[:40]:  # locations are verbatim, and longest
        for m in r["matches"]:
            w = letters(texts[r["doc_id"] - 1])[m["doc_start"]:m["doc_start"] + m["n_words"]]
            assert any(letters(t)[m["item_start"]:m["item_start"] + m["n_words"]] == w
                       for i, t in items if (i or "") == m["item"])


def test_matches_of_empty_tables(llm_spark):
    none = llm_spark.createDataFrame([], "item_id long, text string")
    rows = dec.find_matches(frame(llm_spark, ["a b"]), none).collect()
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in rows] == [(2, 0, [])]
    assert dec.find_matches(frame(llm_spark, []), none).collect() == []


def test_a_prompt_of_many_items_is_looked_up_once(llm_spark):
    from keystat.llm import decontaminate as dec

    prompt = "one two three four five six seven eight nine ten"
    items = [(f"i{i}", f"{prompt} own{i}") for i in range(2000)]
    benchmark = llm_spark.createDataFrame(items, "item_id string, text string")
    docs = frame(llm_spark, [f"{prompt} d{i}" if i % 2 else f"d{i} {prompt[4:]}" for i in range(200)] + [None, ""])
    left = dec.decontaminate(docs, benchmark).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in left) == [*range(1, 201, 2), 201, 202]
    assert dec.decontaminate(docs, benchmark.limit(0)).count() == 202
    assert dec.decontaminate(docs.limit(0), benchmark).collect() == []
