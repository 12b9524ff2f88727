"""Personal data: patterns, and information-theoretic sanitisation of their documents.

Patterns give the base spans (email, ip, card, phone). Each distinct value found
is a protected entity. For a term ``t`` of a document that holds an entity ``c``,
the corpus says how much ``t`` tells of ``c``::

    disclosure = PMI(c; t) / IC(c),  PMI = log2(p(c, t) / (p(c) p(t))),  IC = -log2 p(c)

with probabilities as shares of documents that hold the entity, the term, or
both, anywhere. It reaches 1 when the term is never seen without the entity. A term at
``REMOVE`` or more is removed, one at ``GENERALISE`` or more is generalised to
its word class; both need ``SUPPORT`` documents as evidence. Spans are added wherever
the term stands, outside base spans, in a document that holds that entity, so
documents without entities are left alone.

An entity or term in fewer than ``SUPPORT`` documents has no pair to count, and
as ``p(c, t)`` is at most ``p(c)``, a term with ``p(t) > p(c) ** least`` never
reaches the disclosure ``least``: both are left out before pairs are made, exactly.
Counts cover all documents; they are made by partial sums before each shuffle,
and an entity or term of any frequency is split by Spark's skew joins. Offsets
are code points, ends exclusive. Rows are kept one for one, repeated ones and
null ids too; a null text is empty; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystat.llm.common import materialise

SUPPORT = 2
REMOVE, GENERALISE = 0.9, 0.7

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("term_removed", "term_generalised")

# Patterns. The email's local part is found backwards from each "@", which is
# linear in any text; in the others the quantifiers give nothing back.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W_]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def personal_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of the kind, end, value) of every base span, ordered."""
    found = []
    if "@" in text:
        least = 0
        for m in _DOMAIN.finditer(text):
            start = at = m.start()
            while start > least and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                least = m.end()
                found.append((start, 0, least, text[start:least].lower()))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
                found.append((m.start(), 1, m.end(), m[0]))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end(), digits))
        if "+" in text:
            for m in _PHONE.finditer(text):
                digits = _NOT_DIGIT.sub("", m[0])
                if 10 <= len(digits) <= 15:
                    found.append((m.start(), 3, m.end(), "+" + digits))
    found.sort()
    return found


def _places(text: str, spans: list, wanted: dict[str, int]) -> list[dict]:
    """The spans of the wanted terms (term to place) outside the base spans."""
    covered: list[list[int]] = []
    for s, e in spans:  # disjoint cover of the spans
        if covered and s < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    out, k = [], 0
    for m in _WORD.finditer(text):
        s, end = m.span()
        while k < len(covered) and covered[k][1] <= s:
            k += 1
        if k == len(covered) or end <= covered[k][0]:
            place = wanted.get(m[0].lower())
            if place is not None:
                out.append({"start": s, "place": len(KINDS) + place, "end": end, "kind": TERM_KINDS[place]})
    return out


def _terms(text: str) -> set[str]:
    return {w.lower() for w in set(_WORD.findall(text))}


_SPAN = "struct<start:int,place:int,end:int,kind:string>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("place", pa.int32()), ("end", pa.int32()),
                                 ("kind", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, entities, held = [], [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            found = personal_spans(text)
            spans.append([{"start": s, "place": p, "end": e, "kind": KINDS[p]} for s, p, e, _ in found])
            entities.append(sorted({f"{KINDS[p]}:{v}" for _, p, _, v in found}))
            held.append(text if found else None)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"],
             pa.array(spans, _SPAN_TYPE), pa.array(entities, pa.list_(pa.string())), pa.array(held, pa.string())],
            names=[*[n for n in batch.schema.names if n != "text"], "base_spans", "entities", "held"])


def _terms_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, term) for the distinct terms of every row."""
    for batch in batches:
        for row, value in zip(batch.column("_row"), batch.column("held"), strict=True):
            terms = list(_terms(value.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.as_py()] * len(terms), pa.int64()), pa.array(terms, pa.string())], names=["_row", "term"])


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, added) of rows with their disclosing terms."""
    for batch in batches:
        added = [_places(text, [(s["start"], s["end"]) for s in spans], {w["term"]: w["place"] for w in wanted})
                 for text, spans, wanted in zip(*[batch.column(c).to_pylist() for c in ("held", "base_spans", "wanted")],
                                                strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(added, _SPAN_TYPE)], names=["_row", "added"])


def _documents_with_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the documents that hold each term."""
    def rows(n: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["term", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for value in batch.column("text"):
            counts.update(_terms(value.as_py() or ""))
            if len(counts) > 400_000:  # bounded memory; the shuffle adds the parts up
                yield rows(counts)
                counts = Counter()
    if counts:
        yield rows(counts)


def disclosures(scanned: DataFrame, docs: DataFrame, *, support: int = SUPPORT,
                least: float = GENERALISE) -> DataFrame:
    """(_row, term, disclosure): the terms of ``scanned`` rows that disclose an entity
    of their row by ``least`` or more, with the largest of the row's entities."""
    n = F.lit(scanned.count())
    owned = scanned.select("_row", F.explode("entities").alias("entity"))
    entities = (owned.groupBy("entity").agg(F.count("*").alias("n_c"))
                .where((F.col("n_c") >= support) & (F.col("n_c") < n)))
    owned = materialise(owned.join(entities, "entity"), "entities")
    most = owned.groupBy("_row").agg(F.max("n_c").alias("most"))
    terms = (docs.mapInArrow(_documents_with_term, "term string, n long")
             .groupBy("term").agg(F.sum("n").alias("n_t")).where(F.col("n_t") >= support))
    # n_t / n <= (n_c / n) ** least, with room for rounding
    can = lambda n_c: F.col("n_t") <= n * F.pow(F.col(n_c) / n, F.lit(least)) * 1.000001
    held = (scanned.select("_row", "held").join(most.select("_row"), "_row", "left_semi")
            .mapInArrow(_terms_of_rows, "_row long, term string"))
    told = held.join(terms, "term").join(most, "_row").where(can("most")).select("_row", "term", "n_t")
    pairs = materialise(told.join(owned, "_row").where(can("n_c")), "pairs")
    together = (pairs.groupBy("entity", "term", "n_c", "n_t").agg(F.count("*").alias("n_ct"))
                .where(F.col("n_ct") >= support))
    ratio = F.log2(F.col("n_ct") * n / (F.col("n_c") * F.col("n_t"))) / F.log2(n / F.col("n_c"))
    enough = together.select("entity", "term", ratio.alias("disclosure")).where(F.col("disclosure") >= least)
    return (pairs.select("_row", "entity", "term").join(enough, ["entity", "term"])
            .groupBy("_row", "term").agg(F.max("disclosure").alias("disclosure")))


def find_personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``base_spans`` and ``spans``: arrays of (start, place,
    end, kind), ordered; ``spans`` holds the base spans and the terms'."""
    docs = docs.select(*keep, F.col(text).alias("text"))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    scanned = docs.mapInArrow(_scan, (names + ", " if names else "") + f"base_spans array<{_SPAN}>, "
                              "entities array<string>, held string")
    # row numbers tell repeated rows apart; they are fixed once written
    scanned = materialise(scanned.withColumn("_row", F.monotonically_increasing_id()), "personal")
    place = F.when(F.col("disclosure") >= REMOVE, 0).otherwise(1).alias("place")
    wanted = (disclosures(scanned, docs.select("text")).select("_row", "term", place)
              .groupBy("_row").agg(F.collect_list(F.struct("term", "place")).alias("wanted")))
    added = (scanned.select("_row", "held", "base_spans").join(wanted, "_row")
             .mapInArrow(_mark, f"_row long, added array<{_SPAN}>"))
    spans = F.array_sort(F.concat("base_spans", F.coalesce("added", F.array().cast(f"array<{_SPAN}>"))))
    return scanned.join(added, "_row", "left").select(*keep, "base_spans", spans.alias("spans"))


def _clean(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    out, at = [], 0
    for s in spans:
        if s["start"] < at:
            continue
        word = text[s["start"]:s["end"]]
        kind = "" if s["kind"] == "term_removed" else (
            ("[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]")
            if s["kind"] == "term_generalised" else f"[{s['kind'].upper()}]")
        out += [text[at:s["start"]], kind]
        at = s["end"]
    return "".join([*out, text[at:]])


def sanitised(text: Column, spans: Column) -> Column:
    """The text without its entities (their kind stands there instead) and
    disclosing terms (removed, or their word class instead)."""
    def clean(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_clean(t, s) for t, s in zip(texts, found, strict=True)], dtype=object)

    return F.pandas_udf(clean, T.StringType())(text, spans)
