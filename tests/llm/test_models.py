"""Classifiers, pieces, neighbours, chats and the pipeline."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm import frame, llm_spark  # noqa: F401

from keystat.llm import chat, hnsw, language_id, pieces, quality, queries
from keystat.llm.common import table

SF = "/root/testdata/sf0.01"


def test_language_is_told_on_held_out_rows(llm_spark):
    found = queries.op7_language_id(llm_spark, SF)
    truth = table(llm_spark, SF, "documents").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert sum(r["accepted"] for r in rows) >= 0.99 * len(rows)


def test_language_edge_rows(llm_spark):
    texts = ["the cat and the dog", "der Hund und die Katze"] * 40
    docs = frame(llm_spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de"))
    model = language_id.train(docs)
    odd = frame(llm_spark, [None, "", "123 !", "the dog the cat", "DER HUND " * 30_000, "the dog the cat"],
                [None, 2, 3, 4, 5, 4]).withColumn("score", F.lit("clash"))
    rows = language_id.identify(odd, model).collect()
    assert sorted((str(r["doc_id"]), r["lang_pred"], r["accepted"]) for r in rows) == [
        ("2", "und", False), ("3", "und", False), ("4", "en", True), ("4", "en", True), ("5", "de", True),
        ("None", "und", False)]
    assert all(0 <= r["score"] <= 1 and (r["score"] == 0) == (r["lang_pred"] == "und") for r in rows)
    assert language_id.train(docs.where("lang IS NULL")) is None
    assert {r["lang_pred"] for r in language_id.identify(odd, None).collect()} == {"und"}
    assert language_id.identify(odd.limit(0), model).collect() == []


def test_samples_are_bounded_whatever_the_ids(llm_spark, monkeypatch):
    # no ids, one id and repeated rows: no more rows than the sample says reach the fit
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda rows: seen.append(len(rows)))
    texts = ["the cat and the dog", "der Hund und die Katze"] * 200
    docs = frame(llm_spark, [f"{t} {i}" for i, t in enumerate(texts)], [None] * 400)
    copies = frame(llm_spark, ["the same"] * 400, [1] * 400)
    for d in (docs, copies, docs.union(copies), docs.withColumn("doc_id", F.lit(3))):
        language_id.train(d, sample=60)
    assert seen == [60] * 4
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append((len(x), len(y))))
    labels = llm_spark.createDataFrame([(1, 0), (1, 1)], "doc_id long, quality int")
    quality.train(copies.union(docs), labels, quality.word_vectors(docs), sample=60)
    assert seen[4:] == [(60, 60)]


def test_scores_of_languages_by_plain_sums(llm_spark):
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et le chien"] * 30
    docs = frame(llm_spark, texts).withColumn("lang", F.element_at(F.array(*map(F.lit, ("en", "de", "fr"))),
                                                                   ((F.col("doc_id") - 1) % 3 + 1).cast("int")))
    model = language_id.train(docs)
    asked = ["the chien", "KATZE dog 7", "x", "und le cat " * 700, "dog"]
    for r in language_id.identify(frame(llm_spark, asked), model).collect():
        buckets = language_id.subwords([r["text"].lower()])[0].tolist()
        z = sum(model.table[b].astype(float) for b in buckets) / len(buckets) + model.bias
        p = np.exp(z / model.temperature) / np.exp(z / model.temperature).sum()
        assert r["lang_pred"] == model.languages[int(p.argmax())] and abs(r["score"] - p.max()) < 1e-5
        assert r["accepted"] == (p.max() >= model.threshold)


def test_term_vectors_by_plain_sums(llm_spark):
    texts = ["a calm line", "a calm day", None, "", "Line! line!", "a calm line"] * 3
    got, table_ = quality.word_vectors(frame(llm_spark, texts).repartition(5)), np.zeros((quality.ROWS, quality.DIMENSIONS))
    for t in filter(None, texts):
        data = np.frombuffer(t.encode(), np.uint8)
        word, shape, _ = quality.terms(data, np.array([0, len(data)]))
        key = quality.mix(np.array([sum(int(x) for x in quality.mix(word.astype(np.uint64))) % (1 << 64)], np.uint64))
        (places,), (signs,) = quality._random_vectors(key)
        for row in (*word, *shape):
            for p, s in zip(places, signs, strict=True):
                table_[row, p] += s
    norm = np.linalg.norm(table_, axis=1, keepdims=True)
    assert np.allclose(got, table_ / np.where(norm > 0, norm, 1), atol=1e-6) and got.any()


def plain_subwords(text):
    import itertools
    words = ["".join(g) for k, g in itertools.groupby(text, str.isalpha) if k]
    return Counter(len(w) + 2 - n + 1 for w in words for n in (2, 3) if len(w) + 2 >= n), sum(
        len(w) + 2 - n + 1 for w in words for n in (2, 3) if len(w) + 2 >= n)


def test_subwords_stay_inside_words():
    texts = ["ab c", "", "1 é2", "zz-top", "a"]
    buckets, owner = language_id.subwords(texts)
    assert [int((owner == i).sum()) for i in range(len(texts))] == [plain_subwords(t)[1] for t in texts]
    alone = [Counter(language_id.subwords([t])[0].tolist()) for t in texts]
    assert alone == [Counter(buckets[owner == i].tolist()) for i in range(len(texts))]


def test_quality_on_held_out_rows(llm_spark):
    found = queries.op9_quality_classifier(llm_spark, SF)
    labels = table(llm_spark, SF, "labels").where("quality IS NOT NULL").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["quality"] == r["predicted"] for r in rows) >= 0.9 * len(rows) > 40


def test_quality_edge_rows(llm_spark):
    good, bad = "a calm line of words here", "BUY!! NOW!! $$$ ###"
    docs = frame(llm_spark, [f"{good} {i}" if i % 2 else f"{bad} {i}" for i in range(80)])
    labels = docs.select("doc_id", F.when(F.col("text").startswith("a calm"), 1).otherwise(0).alias("quality"))
    vectors = quality.word_vectors(docs)
    model = quality.train(docs, labels.union(labels.limit(3)), vectors)
    odd = frame(llm_spark, [None, "", good, good, bad, bad * 5000], [None, 1, 2, 2, 3, 4]).withColumn("score", F.lit("x"))
    rows = quality.score_quality(odd, vectors, model).collect()
    by = {r["doc_id"]: r["score"] for r in rows}
    assert len(rows) == 6 and by[2] > 0.7 and by[3] < 0.5 and all(0 <= s <= 1 for s in by.values())
    assert quality.train(docs, labels.limit(0), vectors) is None
    assert {r["score"] for r in quality.score_quality(odd, vectors, None).collect()} == {0.5}
    assert not quality.word_vectors(docs.limit(0)).any()


@pytest.fixture(scope="module")
def model():
    with open(pieces.MODEL, "rb") as f:
        return pieces.Pieces(f.read())


def test_nbest_is_exact(model):
    rng = random.Random(3)

    def every(text):
        into, out = model.edges(text), []

        def go(at, score):
            if at == len(text):
                out.append(score)
            for end in range(at + 1, len(text) + 1):
                for start, more, _ in into[end]:
                    if start == at:
                        go(end, score + more)

        go(0, 0.0)
        return sorted(out, reverse=True)

    for _ in range(300):
        text = "".join(rng.choice("thein é\n▁漢🙂 x") for _ in range(rng.randint(1, 9)))
        found = model.encode(text, 4)
        assert [s for s, _ in found] == every(" " + text)[:4], text
        assert len({ids for _, ids in found}) == len(found)
        assert all(model.decode(ids) == text for _, ids in found)
        assert model.viterbi(" " + text)[:2] == (model.nbest(" " + text, 1)[0][0], model.viterbi(" " + text)[1])


def test_pieces_of_odd_rows(llm_spark):
    texts = [None, "", " ", "a  b\n\n▁c ", "x" * 100_000, "word " * 20_000, "same", "same"]
    docs = frame(llm_spark, texts, [1, 2, 3, 4, 5, 6, 7, 7]).withColumn("pieces", F.lit("clash"))
    rows = pieces.decode(pieces.encode(docs)).collect()
    assert len(rows) == len(texts)
    assert all(r["decoded"] == (r["text"] or "") and len(r["scores"]) <= pieces.NBEST for r in rows)
    assert {len(r["pieces"]) for r in rows if not r["text"]} == {0}
    assert pieces.encode(docs.limit(0)).collect() == []


def test_all_segmentations_are_returned(llm_spark, model):
    texts = [None, "", "the thin", "a", "▁x 漢"]
    rows = pieces.round_trips(pieces.encode(frame(llm_spark, texts), nbest=4)).collect()
    for text, r in zip(texts, sorted(rows, key=lambda r: r["doc_id"]), strict=True):
        want = model.encode(text or "", 4)
        assert [(x["score"], x["ids"]) for x in r["segmentations"]] == [
            (s, np.frombuffer(ids, "<i4").tolist()) for s, ids in want]
        assert r["scores"] == [s for s, _ in want] and r["round_trip"]
        assert r["pieces"] == (r["segmentations"][0]["ids"] if text else [])
    wrong = pieces.encode(frame(llm_spark, ["the thin"])).withColumn("text", F.lit("the thick"))
    assert not pieces.round_trips(wrong).first()["round_trip"]
    found = queries.op8_sentencepiece(llm_spark, "/root/testdata/sf0.001").collect()
    assert all(r["round_trip"] and len(r["segmentation_hashes"]) == len(r["scores"]) for r in found)
    assert all(r["segmentation_hashes"][:1] == [r["pieces_hash"]] * bool(r["n_pieces"]) for r in found)


def brute(ids, vectors, queries_, k):
    out = {}
    for q in queries_:
        own = vectors[ids.index(q)]
        near = sorted({(-float(np.dot(own, v)), i) for i, v in zip(ids, vectors, strict=True) if i != q})
        out[q] = [i for _, i in near[:k]]
    return out


def test_recall_and_ranks(llm_spark):
    found = queries.op10_nearest_neighbours(llm_spark, SF).collect()
    rows = table(llm_spark, SF, "embeddings").select("vec_id", "embedding").collect()
    ids, vectors = [r[0] for r in rows], [np.array(r[1]) for r in rows]
    want = brute(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    got = {q: [x["vec_id"] for x in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])]
           for q in want}
    assert all(len(got[q]) == 20 and len(set(got[q])) == 20 and q not in got[q] for q in want)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)
    at = dict(zip(ids, vectors, strict=True))
    assert all(abs(r["score"] - float(np.dot(at[r["query_id"]], at[r["vec_id"]]))) < 1e-12 for r in found)


def test_copies_ties_and_unusable_vectors(llm_spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(400)]  # one very common vector
    rows += [(1000 + i, rng.normal(size=3).tolist()) for i in range(60)] + [(0, [1.0, 0.0, 0.0])]
    bad = [(2000, None), (2001, [0.0, 0.0, 0.0]), (2002, [1.0, None, 2.0]), (2003, [float("nan"), 1.0, 1.0]),
           (2004, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (2005, []), (2020, [5.0, 5.0])]
    df = llm_spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    asked = df.where("vec_id % 20 = 0")
    index = hnsw.build_index(df, k=5)
    got = {}
    for r in sorted(hnsw.search(index, asked, k=5).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = brute([r[0] for r in rows], [np.array(r[1]) for r in rows], [r[0] for r in rows if r[0] % 20 == 0], 5)
    assert got == want
    none = df.limit(0)
    assert hnsw.search(hnsw.build_index(none), none).collect() == []


def test_chat_round_trip(llm_spark):
    rng = random.Random(4)
    parts = ["<|im_end|>", "<|im_start|>", "\\", "<", "|", "<|im_sep|>", "\n", "~", "é", "assistant", "<\\|"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "a\nb<|", None]), rng.choice([text(), None]))
            for c in (1, 2, None) for t in (*range(150), 3, 3, None)]
    df = llm_spark.createDataFrame(rows + rows[:2], "conv_id long, turn long, role string, text string")
    chats = chat.format_chats(df.withColumn("formatted", F.lit("clash")))
    read = chats.select("conv_id", chat.read_turns(F.col("formatted")).alias("blocks"),
                        chat.loss_text(F.col("segments")).alias("loss")).collect()
    assert len(read) == 3
    for r in read:
        own = sorted(((t is not None, t or 0, role or "", x or "") for c, t, role, x in rows + rows[:2]
                      if c == r["conv_id"]))
        want = [(role, x) for _, _, role, x in own]
        assert [(b["role"], t) for b in r["blocks"] for t in b["texts"]] == want
        assert all(a["role"] != b["role"] for a, b in zip(r["blocks"][:-1], r["blocks"][1:], strict=True))
        assert r["loss"] == "".join(x for role, x in want if role == "assistant")
    assert chat.format_chats(df.limit(0)).collect() == []


def test_pipeline_against_plain_stages(llm_spark):
    import corpus_pipeline as P
    from test_dedup import plain_components, plain_matches, shingles
    from test_spans import plain_secrets
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r for r in table(llm_spark, sf, "documents").collect()}
    items = [(str(r["item_id"]), r["text"]) for r in table(llm_spark, sf, "benchmark").collect()]
    rows = {r["doc_id"]: r for r in P.run(llm_spark, sf).collect()}
    told = {r["doc_id"]: r["accepted"] for r in queries.op7_language_id(llm_spark, sf).collect()}
    ids = [i for i in sorted(docs) if told[i]]
    label = plain_components(ids, [shingles(docs[i]["text"]) for i in ids])
    ids = [i for i in ids if label[i] == i]
    ids = [i for i, m in zip(ids, plain_matches([docs[i]["text"] for i in ids], items), strict=True) if not m[1]]
    assert sorted(rows) == ids
    with open(pieces.MODEL, "rb") as f:
        own = pieces.Pieces(f.read())
    for i in ids:
        text = docs[i]["text"]
        got = own.decode(np.array(rows[i]["pieces"], "<i4").tobytes())
        assert rows[i]["n_pieces"] == len(rows[i]["pieces"]) == len(own.encode(got)[0][1]) // 4
        if not plain_secrets(text):
            assert got == text or "[SECRET]" in got
        else:
            assert "[SECRET]" in got and not plain_secrets(got)


def test_pipeline_searches_and_decodes(llm_spark, model):
    import corpus_pipeline as P
    texts = [None, "", "the thin", "▁x 漢"]
    rows = P.sentencepiece(llm_spark, frame(llm_spark, texts), "").collect()
    for text, r in zip(texts, sorted(rows, key=lambda r: r["doc_id"]), strict=True):
        want = model.encode(text or "", pieces.NBEST)
        assert r["scores"] == [s for s, _ in want] and r["round_trip"]
        assert r["n_pieces"] == len(r["pieces"]) == (len(want[0][1]) // 4 if want else 0)


def test_pipeline_stages_keep_columns(llm_spark):
    import corpus_pipeline as P
    base = table(llm_spark, "/root/testdata/sf0.001", "documents").limit(60)
    extra = base.withColumns({c: F.lit(7) for c in ("score", "accepted", "n_words", "items", "matches", "base_spans")})
    for name, stage in P.STAGES[:-1]:
        out = stage(llm_spark, extra, "/root/testdata/sf0.001")
        assert out.columns == extra.columns, name
        assert {r["score"] for r in out.select("score").collect()} == {7}
        assert stage(llm_spark, extra.limit(0), "/root/testdata/sf0.001").collect() == []


def test_units_searched_together_are_those_searched_alone():
    """The table's passes equal the plain ones, for units of the texts and of random characters."""
    import random

    from keystat.llm import pieces
    with open(pieces.MODEL, "rb") as f:
        own = pieces.Pieces(f.read())
    rng = random.Random(2)
    units = {"", " ", "  ", "a", " the", " Straße", "naïve", "x" * 40, "日本", " €5", "\n"}
    units |= {"".join(rng.choice(" abcdeéßñ'.,0QZ") for _ in range(rng.randrange(1, 14))) for _ in range(3000)}
    got = dict(own.table.viterbi(sorted(units)))
    assert len(got) > 2000 and {"日本", " €5"}.isdisjoint(got)
    assert all(found == own.viterbi(u) for u, found in got.items())


def test_ends_of_units_lose_no_segmentation():
    """N best of whole texts by one search over the whole lattice, against those by units."""
    from keystat.llm import pieces
    with open(pieces.MODEL, "rb") as f:
        own = pieces.Pieces(f.read())
    for text in ("Hello, world. It's (a) test!", "a,b;c:d", "End.", "x-ray's \"quoted\" words, e.g. these", "e.V.,u.a.!"):
        whole = own.nbest(" " + text, 3)
        parts = own.encode(text, 3)
        assert [round(s, 6) for s, _ in whole] == [round(s, 6) for s, _ in parts]
        assert all(own.decode(ids) == text for _, ids in parts)


def test_language_fit_is_small_in_memory():
    """The driver fits beside Spark: the sample stays a list of bags, no dense matrix of all of it."""
    import tracemalloc
    rng = np.random.default_rng(1)
    bags = [("ab"[i % 2], np.unique(rng.integers(i % 2 * 4000, i % 2 * 4000 + 4192, 60)).astype(np.int32)) for i in range(1000)]
    bags = [(lang, buckets, np.ones(len(buckets), np.int32)) for lang, buckets in bags]
    tracemalloc.start()
    try:
        model = language_id.fit(bags)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 << 20  # 1,000 rows of all buckets take 33 MB
    sums = language_id._shares(bags, np.arange(1000)) @ model.table
    assert [model.languages[i] for i in sums.argmax(axis=1)] == [b[0] for b in bags]


def test_units_and_least_losses():
    """The faster cuts and choices of op8 give what the plain ones do."""
    import heapq
    import re
    import sentencepiece
    with open(pieces.MODEL, "rb") as f:
        proto = f.read()
    model = pieces.Pieces(proto)
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    ordinary = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    letters, signs = pieces._LETTERS, pieces._SIGNS
    after = {b for p in ordinary for a, b in zip(p, p[1:]) if a in letters}
    ends = "".join(re.escape(c) for c in signs if c not in after)
    plain = re.compile(rf" *[^ \n{letters}]*[{letters}]+(?=[{ends}])| *[^ \n]+| +|\n")
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice("ab  \n.,;é1(\"'x\t-_") for _ in range(rng.randrange(40)))
        units = model.unit.findall(text)
        assert units == plain.findall(text) and "".join(units) == text
        losses = tuple(rng.choice([0.0, 0.5, 1.0, 2.0, float("inf")]) for _ in range(rng.randrange(6)))
        for n in (1, 2, 4):
            plain_least = heapq.nsmallest(n, zip(losses, range(len(losses))))
            assert [x for x in pieces._least(losses, n) if x[0] < float("inf")] == [x for x in plain_least if x[0] < float("inf")]
