"""Numbers in text fields, by the grammar that ``Double.parseDouble`` documents.

Spark's own cast is wider (``inf``, ``nan`` and ``infinity`` in any case) and trims more kinds of
white space; here a text is a number only if the grammar says so:

* white space around it: characters up to U+0020,
* an optional sign,
* ``NaN``, ``Infinity``, or digits with an optional point and an optional decimal exponent,
  or hexadecimal digits with an optional point and a binary exponent (``0x1.8p3``),
* an optional ``f``, ``F``, ``d`` or ``D`` after digits, which changes nothing.

All of it is one match and one cast, built-in expressions in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of the grammar.
DIGITS = "[0-9]+"
HEX = "[0-9a-fA-F]"
DECIMAL = rf"({DIGITS}[.]?[0-9]*|[.]{DIGITS})([eE][+-]?{DIGITS})?"
HEXADECIMAL = rf"0[xX]({HEX}+[.]?|{HEX}*[.]{HEX}+)[pP][+-]?{DIGITS}"
NUMBER = rf"[+-]?(NaN|Infinity|({DECIMAL}|{HEXADECIMAL})[fFdD]?)"
OUTER = r"[\x00-\x20]*"


def is_number(text: Column) -> Column:
    """Whether a text is a number by the grammar; NULL for NULL."""
    return text.rlike(rf"\A{OUTER}{NUMBER}{OUTER}\z")


def number(text: Column) -> Column:
    """The double that a text stands for; NULL if it is none."""
    core = F.regexp_replace(text, rf"\A{OUTER}|{OUTER}\z", "")
    return F.when(is_number(text), core.try_cast("double"))


def strict_number(text: Column, what: str) -> Column:
    """The double that a text stands for; a missing or bad one fails the job."""
    message = F.concat(F.lit(f"bad {what} field: "), F.coalesce(text, F.lit("missing")))
    return F.when(F.coalesce(is_number(text), F.lit(False)), number(text)).otherwise(F.raise_error(message))
