"""Secret scan: rule matches plus entropy of sliding windows, native Spark SQL.

Rules give the base spans: ``assign`` (a keyword with a value of 8 characters
or more), ``access`` (an ``AKIA`` key of 16 or more) and ``hex`` (a run of 32
or more lower-case hexadecimal digits).

The method adds ``entropy_hex`` and ``entropy_base64`` spans. Candidates are
long runs of a character class that hold a digit and a letter. A window slides
over each candidate; the counts of its characters are kept in an array and
changed by one character in and one out, and with them the sum of
``c * log2(c)``, from which the window's Shannon entropy follows. A candidate
becomes a span, from its first to its last window over the class's threshold,
unless an allow-list pattern matches it whole or a base span overlaps it.

Offsets are code points, ends exclusive. Null texts count as empty; rows are
kept one for one, with repeated rows, null keys and all columns they had; an
empty table gives an empty result. Nothing here is Python at run time, and
there is no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules' patterns.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LENGTH = 8
#: Maximal runs of 16 or more; a shorter run holds no longer match.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharClass:
    """A character class for the entropy windows: its alphabet, the least length
    of a candidate (and the window), and the entropy in bits from which a
    window counts."""

    kind: str
    alphabet: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        chars = "".join("\\" + c if not c.isalnum() else c for c in self.alphabet)
        return rf"(?<![{chars}])[{chars}]{{{self.window},}}"


CLASSES = (
    CharClass("entropy_hex", "0123456789abcdefABCDEF", 20, 3.0),
    CharClass("entropy_base64",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 24, 4.0),
)

#: Candidates that one of these matches whole are no secrets: UUIDs, decimal
#: numbers, dates with times, and repeated or consecutive placeholder digits.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[0-9+/_=-]+",
    r"(.{1,8})\1{2,}.{0,8}",
    r"(0123456789|123456789)(abcdef|ABCDEF).*",
)


#: Running values are made in blocks of so many, at each of ``LEVELS`` levels: up to about 256 ** 3
#: values (a text of hundreds of MB) the totals take less time than the values.
BLOCK = 256
LEVELS = 1
#: Texts are cut for redaction in blocks of so many code points.
CUT = 4096


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once even where lambdas use it."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, zero: int, step: Callable[[Column, Column], Column], levels: int = LEVELS) -> Column:
    """For each of the ``values`` (longs) what ``step`` makes of all before it, from ``zero``. An
    array grows by copies, so values are taken in blocks, which start from the running values of
    the blocks' totals: time is in proportion to the number of values."""
    none = F.array().cast("array<bigint>")
    fold = lambda part: F.aggregate(part, F.lit(zero).cast("bigint"), step)

    def one_block(part: Column, start: Column) -> Column:
        return F.aggregate(
            part, F.struct(start.alias("at"), none.alias("out")),
            lambda acc, x: F.struct(step(acc["at"], x).alias("at"),
                                    F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    if not levels:
        return one_block(values, F.lit(zero).cast("bigint"))

    def blocks(v: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                          lambda k: F.slice(v, k * BLOCK + 1, BLOCK))
        return _let(cut, lambda c: F.flatten(F.zip_with(
            c, _running(F.transform(c, fold), zero, step, levels - 1), one_block)))

    return _let(values, lambda v: F.when(F.size(v) <= BLOCK, one_block(v, F.lit(zero).cast("bigint")))
                .otherwise(blocks(v)))


def _located(text: Column, pattern: str) -> Column:
    """Every match of ``pattern``: (start, end, part), by the lengths of the
    matches and of what lies between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(parts: Column) -> Column:
        lengths = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(parts)), parts,
                             lambda b, f: F.struct(F.length(b).cast("bigint").alias("skip"),
                                                   F.length(f).cast("bigint").alias("own"), f.alias("part")))
        return _let(lengths, lambda n: F.zip_with(
            n, _running(F.transform(n, lambda x: x["skip"] + x["own"]), 0, lambda at, x: at + x),
            lambda x, at: F.struct((at + x["skip"]).cast("int").alias("start"),
                                   (at + x["skip"] + x["own"]).cast("int").alias("end"), x["part"].alias("part"))))

    return _let(found, lambda parts: F.when(
        F.size(parts) == 0, F.array().cast("array<struct<start:int,end:int,part:string>>")).otherwise(placed(parts)))


def _placed(found: Column, kind: str, place: int) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), F.lit(place).alias("place"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def _clear_of(base: Column, more: Column) -> Column:
    """The spans of ``more`` that overlap none of ``base``, by one sorted pass each way: the greatest end of
    the base spans before a span, and the least start of those after it."""
    far = 1 << 40
    both = F.sort_array(F.concat(
        F.transform(base, lambda x: F.struct(x["start"].alias("start"), F.lit(0).alias("place"),
                                             x["end"].alias("end"), x["kind"].alias("kind"))),
        F.transform(more, lambda x: F.struct(x["start"].alias("start"), F.lit(1).alias("place"),
                                             x["end"].alias("end"), x["kind"].alias("kind")))))

    def passes(spans: Column) -> Column:
        ends = F.transform(spans, lambda x: F.when(x["place"] == 0, x["end"]).otherwise(0).cast("bigint"))
        starts = F.reverse(F.transform(spans, lambda x: F.when(x["place"] == 0, x["start"].cast("bigint")).otherwise(far)))
        sides = F.zip_with(_running(ends, 0, lambda m, x: F.greatest(m, x)),
                           F.reverse(_running(starts, far, lambda m, x: F.least(m, x))),
                           lambda before, after: F.struct(before.alias("before"), after.alias("after")))
        marked = F.zip_with(spans, sides, lambda x, side: F.struct(
            ((x["place"] == 1) & (side["before"] <= x["start"]) & (side["after"] >= x["end"])).alias("clear"),
            F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")).alias("span")))
        return F.transform(F.filter(marked, lambda x: x["clear"]), lambda x: x["span"])

    return F.when((F.size(more) == 0) | (F.size(base) == 0), more).otherwise(_let(both, passes))


def _window_span(part: Column, c: CharClass) -> Column:
    """(first, last): starts of the first and the last window of ``part`` whose
    entropy reaches the class's threshold; nulls if there are none."""
    w = c.window
    terms = F.expr("array(" + ", ".join(f"{n * math.log2(n) if n else 0.0!r}D" for n in range(w + 2)) + ")")
    # entropy = log2(w) - sum / w, so the threshold is an upper bound of the sum
    most = w * (math.log2(w) - c.bits) + 1e-9
    places = F.expr("array(" + ", ".join(str(c.alphabet.find(chr(b))) for b in range(128)) + ")")
    symbols = F.transform(F.split(part, "", -1), lambda x: F.get(places, F.ascii(x)))
    term = lambda n: F.element_at(terms, n + 1)

    def step(acc: Column, i: Column) -> Column:
        s = acc["symbols"]
        new = F.get(s, i)
        old = F.when(i >= w, F.get(s, i - w))
        # one symbol in, then one out; both changes reach the counts and the sum
        n_new = F.get(acc["counts"], new)
        n_old = F.coalesce(F.get(acc["counts"], old) + F.when(old == new, 1).otherwise(0), F.lit(1))
        total = (acc["total"] - term(n_new) + term(n_new + 1)
                 + F.when(i >= w, term(n_old - 1) - term(n_old)).otherwise(0.0))
        counts = F.transform(acc["counts"], lambda n, k: (
            n + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0)))
        hit = (i >= w - 1) & (total <= most)
        at = i - (w - 1)
        return F.struct(s.alias("symbols"), counts.alias("counts"), total.alias("total"),
                        F.coalesce(acc["first"], F.when(hit, at)).alias("first"),
                        F.when(hit, at).otherwise(acc["last"]).alias("last"))

    return F.aggregate(
        F.sequence(F.lit(0), F.length(part) - 1),
        F.struct(symbols.alias("symbols"),
                 F.array_repeat(F.lit(0), len(c.alphabet)).alias("counts"), F.lit(0.0).alias("total"),
                 F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last")),
        step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _entropy_spans(found: Column, c: CharClass, allowed: tuple[str, ...]) -> Column:
    likely = F.filter(found, lambda x: F.rlike(x["part"], F.lit("[0-9]"))
                      & F.rlike(x["part"], F.lit("[A-Za-z]"))
                      & ~F.rlike(x["part"], F.lit("^(" + "|".join(f"({p})" for p in _renumbered(allowed)) + ")$")))
    scored = F.transform(likely, lambda x: F.struct(
        x["start"].alias("start"), _window_span(x["part"], c).alias("hot")))
    return F.transform(F.filter(scored, lambda x: x["hot"]["first"].isNotNull()), lambda x: F.struct(
        (x["start"] + x["hot"]["first"]).alias("start"),
        (x["start"] + x["hot"]["last"] + c.window).alias("end"), F.lit(c.kind).alias("kind")))


def _renumbered(patterns: tuple[str, ...]) -> list[str]:
    """Back references ``\\1`` made right for patterns joined into one: the joined
    pattern opens one group, and each pattern one more before its own."""
    out, groups = [], 1
    for p in patterns:
        own = p.replace("\\(", "").replace("(?", "").count("(")
        out.append(p.replace("\\1", f"\\{groups + 2}"))
        groups += 1 + own
    return out


def scan_secrets(docs: DataFrame, text: str = "text", *, classes: tuple[CharClass, ...] = CLASSES,
                 allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with two columns more: ``base_spans``, the rules' spans ordered by
    start and kind, and ``secret_spans``, those and the entropy spans that overlap
    none of them, ordered by start. Input columns of these names are replaced."""
    for name in ("base_spans", "secret_spans"):
        docs = docs.drop(name) if name != text else docs
    whole = F.coalesce(F.col(text), F.lit(""))
    marks = [f"__{k}" for k in (*KINDS, *[c.kind for c in classes])]
    found = docs.withColumns({
        "__assign": _located(whole, ASSIGN), "__access": _located(whole, ACCESS), "__hex": _located(whole, HEX),
        "__value": F.regexp_extract_all(whole, F.lit(ASSIGN), F.lit(2)),
        **{f"__{c.kind}": _located(whole, c.pattern) for c in classes}})
    long_enough = F.filter(
        F.zip_with("__assign", "__value", lambda x, v: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.length(v).alias("value"))),
        lambda x: x["value"] >= ASSIGN_LENGTH)
    # structs are ordered by start, then by the kind's place in the list
    base = F.sort_array(F.concat(*[
        _placed(x, kind, i) for i, (kind, x)
        in enumerate(zip(KINDS, (long_enough, F.col("__access"), F.col("__hex")), strict=True))]))
    found = found.withColumn("base_spans", F.transform(base, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    more = F.concat(*[_entropy_spans(F.col(f"__{c.kind}"), c, allowed) for c in classes])
    found = found.withColumn("secret_spans", _let(more, lambda m: F.sort_array(
        F.concat(F.col("base_spans"), _clear_of(F.col("base_spans"), m)))))
    return found.drop(*marks, "__value")


def redact(text: str = "text", spans: str = "secret_spans", mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by ``mark``;
    a null text stays null. Each part is cut from blocks of ``CUT`` code points, which takes time
    in proportion to the text, however many spans there are."""
    whole = F.col(text)

    def part(blocks: Column, start: Column, end: Column) -> Column:
        cut = lambda k: F.substring(F.get(blocks, k), F.greatest(start - k * CUT, F.lit(0)) + 1,
                                    F.least(end - k * CUT, F.lit(CUT)) - F.greatest(start - k * CUT, F.lit(0)))
        place = lambda at: F.floor(at / CUT).cast("int")
        return F.when(end <= start, "").otherwise(
            F.array_join(F.transform(F.sequence(place(start), place(end - 1)), cut), ""))

    def rebuilt(both: Column) -> Column:
        blocks, found = both["blocks"], both["spans"]
        reach = _running(F.transform(found, lambda x: x["end"].cast("bigint")), 0, lambda m, x: F.greatest(m, x))
        pieces = F.zip_with(found, reach, lambda x, at: F.when(x["start"] >= at, F.concat(
            part(blocks, at.cast("int"), x["start"]), F.lit(mark))).otherwise(""))
        tail = part(blocks, F.array_max(F.transform(found, lambda x: x["end"])), F.length(whole))
        return F.concat(F.array_join(pieces, ""), tail)

    blocks = F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, whole).otherwise(
        _let(F.struct(blocks.alias("blocks"), F.col(spans).alias("spans")), rebuilt))
